"""Registered queries (one per operator of the inventory) and their DuckDB oracle SQL.

Every query reads the driver's tables at ``sf_dir`` (or frames Spark derives from them) in full.
Computed columns carry the same names in the Spark result and in the SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import inputs as I
from .inputs import sql_strip, with_inputs
from .pipelines import prepare_bitext, split_summary
from ..operators import clean, split as splitops
from ..operators.clean import SAMPLE_T2S_CHARS
from ..sources import tsv

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def _split_sql(rel: str) -> str:
    return f"(SELECT pair_id, string_split(value, chr(9)) AS f FROM {rel})"


T2S_FROM = "".join(SAMPLE_T2S_CHARS)
T2S_TO = "".join(SAMPLE_T2S_CHARS.values())

# C1 as DuckDB CTEs (after the raw inputs)
C1_CTES = [
    ("news", f"SELECT 'news' AS corpus, pair_id, f[1] AS en, f[2] AS zh FROM {_split_sql('raw_news')}"),
    ("titles", f"SELECT 'titles' AS corpus, pair_id, f[2] AS en, translate(f[1], '{T2S_FROM}', '{T2S_TO}') AS zh "
               f"FROM {_split_sql('raw_titles')}"),
    ("mined", f"SELECT 'mined' AS corpus, pair_id, f[2] AS en, translate(f[3], '{T2S_FROM}', '{T2S_TO}') AS zh "
              f"FROM {_split_sql('raw_mined')}"),
    ("united", "SELECT * FROM news UNION ALL SELECT * FROM titles UNION ALL SELECT * FROM mined"),
    ("cleaned", f"SELECT corpus, pair_id, {sql_strip('en')} AS en, {sql_strip('zh')} AS zh FROM united "
                f"WHERE length({sql_strip('en')}) > 0 AND length({sql_strip('zh')}) > 0"),
    ("keyed", "SELECT *, ('0x' || substr(md5('1:' || corpus || ':' || CAST(pair_id AS VARCHAR)), 1, 8))::BIGINT "
              "AS shuffle_key FROM cleaned"),
    ("ranked", "SELECT *, row_number() OVER (ORDER BY shuffle_key, corpus, pair_id) - 1 AS r, "
               "count(*) OVER () AS n FROM keyed"),
    ("c1", "SELECT corpus, pair_id, en, zh, CASE WHEN r < ceil(0.2 * n) THEN 'test' "
           "WHEN r < ceil(0.2 * n) + ceil(0.125 * (n - ceil(0.2 * n))) THEN 'val' ELSE 'train' END AS split "
           "FROM ranked"),
]
C1_WITH = with_inputs("raw_news", "raw_titles", "raw_mined", extra=C1_CTES)


def c1(spark, sf_dir, positions: bool = False, sides=("en", "zh")) -> DataFrame:
    return prepare_bitext(I.raw_news(spark, sf_dir), I.raw_titles(spark, sf_dir),
                          I.raw_mined(spark, sf_dir), chars=SAMPLE_T2S_CHARS, positions=positions, sides=sides)


# ---------------------------------------------------------------------------------------------
# 1. Sources, cleaning, split, C1
# ---------------------------------------------------------------------------------------------

@register("src_pairs_tsv", with_inputs("raw_news") +
          f"SELECT pair_id, f[1] AS en, f[2] AS zh FROM {_split_sql('raw_news')}")
def q_src_pairs_tsv(spark, sf_dir):
    return tsv.read_pairs(I.raw_news(spark, sf_dir))


@register("src_titles_tsv", with_inputs("raw_titles") +
          f"SELECT pair_id, f[2] AS en, f[1] AS zh FROM {_split_sql('raw_titles')}")
def q_src_titles_tsv(spark, sf_dir):
    return tsv.read_titles(I.raw_titles(spark, sf_dir))


@register("src_mined_tsv", with_inputs("raw_mined") +
          "SELECT pair_id, CAST(f[1] AS DOUBLE) AS score, f[2] AS en, f[3] AS zh, f[4] AS from_lang, "
          f"f[5] AS to_lang FROM {_split_sql('raw_mined')}")
def q_src_mined_tsv(spark, sf_dir):
    return tsv.read_mined(I.raw_mined(spark, sf_dir))


CORPUS_FILES = 16           # texts the lines of a corpus are dealt to


def corpus_files(spark, sf_dir, name: str) -> str:
    """A corpus as texts, one a bucket of pair ids, its lines in order; the texts S1-S3 read.  A text is a folder of parts
    that hold ranges of its pair ids, so no task has a whole bucket."""
    lines = I.BUILDERS[name](spark, sf_dir).withColumn("bucket", F.pmod("pair_id", F.lit(CORPUS_FILES)))
    path = scratch_path(spark, f"corpus-{name}")
    parts = max(CORPUS_FILES, int(spark.conf.get("spark.sql.shuffle.partitions")))
    (lines.repartitionByRange(parts, "bucket", "pair_id").sortWithinPartitions("bucket", "pair_id").select("bucket", "value")
     .write.partitionBy("bucket").text(path))
    return path


def _files_sql(name: str) -> str:
    """Lines of the files with the ids that reading them gives: the file's number in path order, the line's offset."""
    return f"""(SELECT CAST((dense_rank() OVER (ORDER BY CAST(bucket AS VARCHAR)) - 1) * {1 << tsv.FILE_BITS} + before AS BIGINT) AS pair_id,
        CAST(before AS BIGINT) AS "offset", string_split(value, chr(9)) AS f FROM (
        SELECT bucket, value, coalesce(sum(strlen(value) + 1) OVER (PARTITION BY bucket ORDER BY pair_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
        FROM (SELECT pair_id, value, pair_id % {CORPUS_FILES} AS bucket FROM {name}) b) o)"""


def _file_lines(spark, sf_dir, name: str) -> DataFrame:
    return tsv.read_text_lines(spark, corpus_files(spark, sf_dir, name), folders=True)


def _with_offset(parsed: DataFrame) -> DataFrame:
    return parsed.withColumn("offset", F.col("pair_id").bitwiseAND(F.lit((1 << tsv.FILE_BITS) - 1)))


@register("src_pairs_file", with_inputs("raw_news") +
          f"""SELECT pair_id, "offset", f[1] AS en, f[2] AS zh FROM {_files_sql('raw_news')}""")
def q_src_pairs_file(spark, sf_dir):
    return _with_offset(tsv.read_pairs(_file_lines(spark, sf_dir, "raw_news")))


@register("src_titles_file", with_inputs("raw_titles") +
          f"""SELECT pair_id, "offset", f[2] AS en, f[1] AS zh FROM {_files_sql('raw_titles')}""")
def q_src_titles_file(spark, sf_dir):
    return _with_offset(tsv.read_titles(_file_lines(spark, sf_dir, "raw_titles")))


@register("src_mined_file", with_inputs("raw_mined") +
          """SELECT pair_id, "offset", CAST(f[1] AS DOUBLE) AS score, f[2] AS en, f[3] AS zh, f[4] AS from_lang, """
          f"f[5] AS to_lang FROM {_files_sql('raw_mined')}")
def q_src_mined_file(spark, sf_dir):
    return _with_offset(tsv.read_mined(_file_lines(spark, sf_dir, "raw_mined")))


@register("strip_pairs", with_inputs("bitext") +
          f"SELECT pair_id, {sql_strip('en')} AS en, {sql_strip('zh')} AS zh FROM bitext")
def q_strip_pairs(spark, sf_dir):
    return clean.strip_pairs(I.bitext(spark, sf_dir))


@register("nonempty_pairs", with_inputs("raw_bad") +
          f"SELECT pair_id, en, zh FROM (SELECT pair_id, {sql_strip('f[1]')} AS en, {sql_strip('f[2]')} AS zh "
          f"FROM {_split_sql('raw_bad')} WHERE len(f) = 2) WHERE length(en) > 0 AND length(zh) > 0")
def q_nonempty_pairs(spark, sf_dir):
    return clean.clean_pairs(tsv.read_pairs(I.raw_bad(spark, sf_dir), mode="DROPMALFORMED"))


@register("arity_rejects", with_inputs("raw_bad") +
          "SELECT pair_id, value AS line, CAST(len(string_split(value, chr(9))) AS INTEGER) AS n_fields "
          "FROM raw_bad WHERE len(string_split(value, chr(9))) <> 2")
def q_arity_rejects(spark, sf_dir):
    return tsv.arity_rejects(I.raw_bad(spark, sf_dir), 2)


@register("union_corpora", C1_WITH + "SELECT corpus, pair_id, en, zh FROM united")
def q_union_corpora(spark, sf_dir):
    frames = {"news": tsv.read_pairs(I.raw_news(spark, sf_dir)),
              "titles": tsv.read_titles(I.raw_titles(spark, sf_dir)).withColumn(
                  "zh", clean.convert_chars("zh", SAMPLE_T2S_CHARS)),
              "mined": clean.convert_where(tsv.read_mined(I.raw_mined(spark, sf_dir)),
                                           chars=SAMPLE_T2S_CHARS).select("pair_id", "en", "zh")}
    return splitops.union_corpora(frames).select("corpus", "pair_id", "en", "zh")


@register("seeded_order", C1_WITH + "SELECT corpus, pair_id, shuffle_key, r AS pos FROM ranked")
def q_seeded_order(spark, sf_dir):
    cleaned = clean.clean_pairs(q_union_corpora(spark, sf_dir))
    return splitops.seeded_order(cleaned, ["corpus", "pair_id"], total=None).select(
        "corpus", "pair_id", "shuffle_key", "pos")


@register("dense_position", with_inputs("doc_lines") +
          "SELECT doc_id, pos, row_number() OVER (ORDER BY doc_id, pos) - 1 AS line_no FROM doc_lines")
def q_dense_position(spark, sf_dir):
    return splitops.dense_position(I.doc_lines(spark, sf_dir).select("doc_id", "pos"),
                                   ["doc_id", "pos"], out="line_no")


@register("exact_split", with_inputs("bitext") + """SELECT pair_id, CASE WHEN r < ceil(0.2 * n) THEN 'test'
        WHEN r < ceil(0.2 * n) + ceil(0.125 * (n - ceil(0.2 * n))) THEN 'val' ELSE 'train' END AS split
    FROM (SELECT pair_id, row_number() OVER (ORDER BY k, pair_id) - 1 AS r, count(*) OVER () AS n
          FROM (SELECT pair_id, ('0x' || substr(md5('1:' || CAST(pair_id AS VARCHAR)), 1, 8))::BIGINT AS k
                FROM bitext))""")
def q_exact_split(spark, sf_dir):
    return splitops.exact_split(I.bitext(spark, sf_dir), ["pair_id"]).select("pair_id", "split")


@register("hash_split", with_inputs("bitext") + """SELECT pair_id, CASE WHEN b < 200 THEN 'test'
        WHEN b < 300 THEN 'val' ELSE 'train' END AS split
    FROM (SELECT pair_id, ('0x' || substr(md5('1:' || CAST(pair_id AS VARCHAR)), 1, 8))::BIGINT % 1000 AS b
          FROM bitext)""")
def q_hash_split(spark, sf_dir):
    return splitops.hash_split(I.bitext(spark, sf_dir), ["pair_id"]).select("pair_id", "split")


@register("prepare_bitext", C1_WITH + "SELECT * FROM c1")
def q_prepare_bitext(spark, sf_dir):
    return c1(spark, sf_dir)


@register("split_counts", C1_WITH + """SELECT split, count(*) AS n_pairs,
        round(avg(length(en)), 6) AS avg_en_chars, round(avg(length(zh)), 6) AS avg_zh_chars
    FROM c1 GROUP BY split""")
def q_split_counts(spark, sf_dir):
    return split_summary(c1(spark, sf_dir))


# ---------------------------------------------------------------------------------------------
# 2. Text functions
# ---------------------------------------------------------------------------------------------

from ..functions import text as TX  # noqa: E402
from ..operators import encode as EN, vocab as VO  # noqa: E402

WORD_RE_SQL = r"'[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]+'"
CJK_SQL = "'" + TX.CJK_CLASS + "'"


def ids_str(col) -> "F.Column":
    c = F.col(col) if isinstance(col, str) else col
    return F.array_join(c.cast("array<string>"), " ")


def _zh_tokens_sql(x: str) -> str:
    s = f"regexp_replace({sql_strip(x)}, {CJK_SQL}, ' \\0 ', 'g')"
    reps = [(r"([\{-\~\[-\` -\&\(-\+\:-\@\/])", r" \1 "), (r"([^0-9])([\.,])", r"\1 \2 "),
            (r"([\.,])([^0-9])", r" \1 \2"), (r"([0-9])(-)", r"\1 \2 ")]
    for pat, rep in reps:
        s = f"regexp_replace({s}, '{pat}', '{rep}', 'g')"
    return f"trim(regexp_replace({s}, '\\s+', ' ', 'g'))"


@register("normalize_text", with_inputs("doc_lines") +
          "SELECT doc_id, pos, strip_accents(lower(line)) AS norm FROM doc_lines")
def q_normalize_text(spark, sf_dir):
    return I.doc_lines(spark, sf_dir).select("doc_id", "pos", TX.normalize("line").alias("norm"))


@register("pretok_words", with_inputs("doc_lines") +
          f"""SELECT doc_id, pos, CAST(len(t) AS INTEGER) AS n_tokens, array_to_string(t, ' ') AS tokens
    FROM (SELECT doc_id, pos, regexp_extract_all(line, {WORD_RE_SQL}) AS t FROM doc_lines)""")
def q_pretok_words(spark, sf_dir):
    t = TX.pretok_words("line")
    return I.doc_lines(spark, sf_dir).select("doc_id", "pos", F.size(t).alias("n_tokens"),
                                             F.array_join(t, " ").alias("tokens"))


# The split pattern without its look-ahead: a mark before the last white space of a run that a character follows.
SPACE_SQL = r"[\s\x0B\x{85}\p{Z}]"
NO_SPACE_SQL = r"[^\s\x0B\x{85}\p{Z}]"
SPACE_MARK = "\ue000"
BYTE_PIECES_RE = (r"''s|''t|''re|''ve|''m|''ll|''d| ?\p{L}+| ?\p{N}+| ?[^\s\x0B\x{85}\p{Z}\p{L}\p{N}" + SPACE_MARK + "]+|"
                  + SPACE_SQL + "+")


def _byte_pieces_sql(x: str) -> str:
    """F5 in SQL: the pieces of ``x`` with a space in front, each as the symbols of its UTF-8 bytes (null: null)."""
    symbols = "".join(TX.BYTE_TO_CHAR[b] for b in range(256)).replace("'", "''")
    marked = (f"regexp_replace(CASE WHEN starts_with({x}, ' ') THEN {x} ELSE ' ' || {x} END, "
              f"'({SPACE_SQL})({NO_SPACE_SQL})', '{SPACE_MARK}\\1\\2', 'g')")
    return (f"list_transform(regexp_extract_all({marked}, '{BYTE_PIECES_RE}'), lambda p: array_to_string(list_transform("
            f"range(strlen(p)), lambda i: substring('{symbols}', ('0x' || hex(p)[2 * i + 1:2 * i + 2])::INTEGER + 1, 1)), ''))")


@register("pretok_bytes", with_inputs("bitext") + f"""SELECT pair_id, CAST(len(t) AS INTEGER) AS n_pieces, array_to_string(t, ' ') AS pieces
    FROM (SELECT pair_id, {_byte_pieces_sql('zh')} AS t FROM bitext)""")
def q_pretok_bytes(spark, sf_dir):
    t = TX.pretok_bytes("zh")
    return I.bitext(spark, sf_dir).select("pair_id", F.size(t).alias("n_pieces"),
                                          F.array_join(t, " ").alias("pieces"))


@register("bytes_roundtrip", with_inputs("doc_lines") + "SELECT doc_id, pos, line FROM doc_lines")
def q_bytes_roundtrip(spark, sf_dir):
    pieces = TX.pretok_bytes("line", add_prefix_space=False)
    back = TX.symbols_to_text(F.array_join(pieces, ""))
    return I.doc_lines(spark, sf_dir).select("doc_id", "pos", back.alias("line"))


@register("script_convert", with_inputs("bitext") +
          f"SELECT pair_id, translate(zh, '{T2S_FROM}', '{T2S_TO}') AS zh FROM bitext")
def q_script_convert(spark, sf_dir):
    return I.bitext(spark, sf_dir).select(
        "pair_id", clean.convert_script("zh", SAMPLE_T2S_CHARS).alias("zh"))


PHRASE_LETTERS = 12         # words of so many letters, and their first four letters, are the phrases of the query's dictionary


def phrase_table(spark, sf_dir) -> DataFrame:
    """A dictionary (source, target) from the table's own words: long words turn round, their first four letters, where no
    phrase covers them, into capitals.  Short phrases begin longer ones, so the longest match decides."""
    words = I.bitext(spark, sf_dir).select(F.explode(F.regexp_extract_all(
        F.lower("zh"), F.lit(f"[a-z]{{{PHRASE_LETTERS},}}"), F.lit(0))).alias("w")).distinct()
    return words.select("w", F.reverse("w").alias("dst")).unionByName(
        words.select(F.substring("w", 1, 4).alias("w"), F.upper(F.substring("w", 1, 4)).alias("dst")).distinct())


PHRASE_CTES = [
    ("words", f"SELECT DISTINCT unnest(regexp_extract_all(lower(zh), '[a-z]{{{PHRASE_LETTERS},}}')) AS w FROM bitext"),
    ("phrases", "SELECT w AS src, reverse(w) AS dst FROM words UNION SELECT w[1:4], upper(w[1:4]) FROM words"),
    ("pattern", "SELECT string_agg(src, '|' ORDER BY len(src) DESC, src) || '|[\\s\\S]' AS p FROM phrases"),
    ("dict", "SELECT map_from_entries(list((src, dst))) AS m FROM phrases"),
]


@register("phrase_convert", with_inputs("bitext", extra=PHRASE_CTES) +
          """SELECT pair_id, coalesce(array_to_string(list_transform(regexp_extract_all(lower(zh), p),
        lambda x: coalesce(m[x], x)), ''), '') AS zh FROM bitext, pattern, dict""")
def q_phrase_convert(spark, sf_dir):
    return I.bitext(spark, sf_dir).select(
        "pair_id", clean.convert_phrases(F.lower("zh"), phrase_table(spark, sf_dir)).alias("zh"))


@register("zh_tokens", with_inputs("bitext") +
          f"SELECT pair_id, {_zh_tokens_sql('en')} AS tokens FROM bitext")
def q_zh_tokens(spark, sf_dir):
    return I.bitext(spark, sf_dir).select("pair_id", F.array_join(TX.zh_tokens("en"), " ").alias("tokens"))


def _cleanup_sql(x: str) -> str:
    for old, new in TX.CLEANUP_REPLACEMENTS:
        x = f"replace({x}, '{old.replace(chr(39), chr(39) * 2)}', '{new.replace(chr(39), chr(39) * 2)}')"
    return x


@register("cleanup_spaces", with_inputs("bitext") +
          f"SELECT pair_id, {_cleanup_sql(_zh_tokens_sql('en'))} AS text FROM bitext")
def q_cleanup_spaces(spark, sf_dir):
    toks = F.array_join(TX.zh_tokens("en"), " ")
    return I.bitext(spark, sf_dir).select("pair_id", TX.cleanup_spaces(toks).alias("text"))


@register("tokenizer_by_lang", with_inputs("bitext") + f"""SELECT pair_id,
        array_to_string(regexp_extract_all(strip_accents(lower(en)), {WORD_RE_SQL}), ' ') AS en_tokens,
        array_to_string({_byte_pieces_sql('x')}, ' ') AS zh_tokens
    FROM (SELECT pair_id, en, strip_accents(lower(zh)) AS x FROM bitext)""")
def q_tokenizer_by_lang(spark, sf_dir):
    from ..operators.bpe import tokenizer_for
    en, zh = tokenizer_for("en"), tokenizer_for("zh")
    b = I.bitext(spark, sf_dir)
    return b.select("pair_id",
                    F.array_join(en.pretokenize(en.normalize(F.col("en"))), " ").alias("en_tokens"),
                    F.array_join(zh.pretokenize(zh.normalize(F.col("zh"))), " ").alias("zh_tokens"))


# ---------------------------------------------------------------------------------------------
# 3. Vocabularies and word ids
# ---------------------------------------------------------------------------------------------

SPECIALS_SQL = "(VALUES ('<unk>', 0), ('<pad>', 1), ('<bos>', 2), ('<eos>', 3)) s(token, id)"
WORD_VOCAB_CTES = [
    ("doc_words", f"SELECT unnest(regexp_extract_all(lower(text), {WORD_RE_SQL})) AS word FROM documents"),
    ("doc_counts", "SELECT word, count(*) AS count FROM doc_words GROUP BY word"),
    ("word_vocab", f"""SELECT token, id FROM {SPECIALS_SQL} UNION ALL
        SELECT word AS token, CAST(row_number() OVER (ORDER BY count DESC, word) + 3 AS INTEGER) AS id
        FROM doc_counts WHERE count >= 4 AND word NOT IN ('<unk>', '<pad>', '<bos>', '<eos>')"""),
    ("en_toks", f"""SELECT pair_id, unnest(t) AS token, unnest(range(1, len(t) + 1)) AS pos
        FROM (SELECT pair_id, regexp_extract_all(lower(en), {WORD_RE_SQL}) AS t FROM bitext)"""),
    ("en_ids", """SELECT b.pair_id, coalesce(list(coalesce(v.id, 0) ORDER BY t.pos)
            FILTER (WHERE t.pos IS NOT NULL), []) AS ids
        FROM bitext b LEFT JOIN en_toks t ON t.pair_id = b.pair_id LEFT JOIN word_vocab v ON v.token = t.token
        GROUP BY b.pair_id"""),
]
WORD_WITH = with_inputs("bitext", extra=WORD_VOCAB_CTES)


def doc_word_vocab(spark, sf_dir) -> DataFrame:
    docs = read_table_cols(spark, sf_dir, "documents", "text")
    counts = VO.word_counts(docs, TX.pretok_words(F.lower("text")))
    return VO.word_vocab(counts)


def read_table_cols(spark, sf_dir, name, *cols):
    from ..session import read_table
    return read_table(spark, sf_dir, name).select(*cols)


def bitext_word_ids(spark, sf_dir) -> DataFrame:
    b = I.bitext(spark, sf_dir).select("pair_id", TX.pretok_words(F.lower("en")).alias("toks"))
    return EN.word_ids(b, "toks", doc_word_vocab(spark, sf_dir), out="ids")


def c1_train_words(spark, sf_dir) -> DataFrame:
    train = c1(spark, sf_dir).where(F.col("split") == "train")
    return VO.word_counts(train, TX.pretok_words(TX.normalize("zh")))


C1_WORD_CTES = [
    ("train_words", f"""SELECT word, count(*) AS count FROM (SELECT unnest(regexp_extract_all(
        strip_accents(lower(zh)), {WORD_RE_SQL})) AS word FROM c1 WHERE split = 'train') GROUP BY word"""),
]
C1_WORD_WITH = with_inputs("raw_news", "raw_titles", "raw_mined", extra=C1_CTES + C1_WORD_CTES)


@register("word_counts", C1_WORD_WITH + "SELECT word, count FROM train_words")
def q_word_counts(spark, sf_dir):
    return c1_train_words(spark, sf_dir)


@register("alphabet", C1_WORD_WITH + """SELECT token, CAST(row_number() OVER (ORDER BY token) + 3 AS INTEGER) AS id
    FROM (SELECT DISTINCT unnest(string_split(word, '')) AS token FROM train_words)""")
def q_alphabet(spark, sf_dir):
    return VO.alphabet(c1_train_words(spark, sf_dir))


@register("word_vocab", with_inputs(extra=WORD_VOCAB_CTES[:3]) + "SELECT token, id FROM word_vocab")
def q_word_vocab(spark, sf_dir):
    return doc_word_vocab(spark, sf_dir)


@register("vocab_size", with_inputs(extra=WORD_VOCAB_CTES[:3]) +
          "SELECT count(*) AS vocab_size FROM word_vocab")
def q_vocab_size(spark, sf_dir):
    return VO.vocab_size(doc_word_vocab(spark, sf_dir))


@register("word_ids", WORD_WITH + """SELECT pair_id, CAST(len(ids) AS INTEGER) AS n_ids,
        array_to_string(ids, ' ') AS ids FROM en_ids""")
def q_word_ids(spark, sf_dir):
    w = bitext_word_ids(spark, sf_dir)
    return w.select("pair_id", F.size("ids").alias("n_ids"), ids_str("ids").alias("ids"))


@register("decode_ids", WORD_WITH + """SELECT b.pair_id, coalesce(string_agg(v.token, ' ' ORDER BY t.pos)
        FILTER (WHERE v.id > 3), '') AS text
    FROM bitext b LEFT JOIN en_toks t ON t.pair_id = b.pair_id LEFT JOIN word_vocab v ON v.token = t.token
    GROUP BY b.pair_id""")
def q_decode_ids(spark, sf_dir):
    return EN.decode_ids(bitext_word_ids(spark, sf_dir), "ids", doc_word_vocab(spark, sf_dir))


# ---------------------------------------------------------------------------------------------
# 7. BPE (the R keys are checked against the public tokenizers package in tests)
# ---------------------------------------------------------------------------------------------

from ..operators import bpe as BP  # noqa: E402

def c1_train(spark, sf_dir) -> DataFrame:
    return c1(spark, sf_dir).where(F.col("split") == "train")


def _train(rows: DataFrame, lang: str) -> "BP.BpeModel":
    """A4 on the train split of C1 rows to its end: 30,000 entries or no pair left."""
    return BP.train_bpe(rows.where(F.col("split") == "train"), lang, lang)


C1_EN_WORD_CTES = [
    ("en_words", f"""SELECT word, count(*) AS c FROM (SELECT unnest(regexp_extract_all(
        strip_accents(lower(en)), {WORD_RE_SQL})) AS word FROM c1 WHERE split = 'train') GROUP BY word"""),
    ("en_pairs", """SELECT chars[i] AS a, chars[i + 1] AS b, CAST(sum(c) AS BIGINT) AS count
        FROM (SELECT string_split(word, '') AS chars, c FROM en_words) w,
             LATERAL (SELECT unnest(range(1, len(w.chars))) AS i) r
        GROUP BY ALL"""),
]
C1_EN_WITH = with_inputs("raw_news", "raw_titles", "raw_mined", extra=C1_CTES + C1_EN_WORD_CTES)


def _en_char_words(spark, sf_dir) -> DataFrame:
    train = c1_train(spark, sf_dir)
    w = BP.training_words(train, "en", "en")
    return w.select(F.regexp_extract_all("word", F.lit(r"(?s)."), 0).alias("syms"), "c")


@register("bpe_pair_counts", C1_EN_WITH + "SELECT a, b, count FROM en_pairs")
def q_bpe_pair_counts(spark, sf_dir):
    return BP.pair_counts(_en_char_words(spark, sf_dir))


@register("bpe_best_pair", C1_EN_WITH + "SELECT a, b, count FROM en_pairs ORDER BY count DESC, a, b LIMIT 1")
def q_bpe_best_pair(spark, sf_dir):
    return BP.best_pairs(BP.pair_counts(_en_char_words(spark, sf_dir)), 1)


@register("bpe_merges")
def q_bpe_merges(spark, sf_dir):
    return _train(c1(spark, sf_dir, sides=["en"]), "en").merges_frame(spark)


@register("tokenizer_tables")
def q_tokenizer_tables(spark, sf_dir):
    """Both tables of the written tokenizer: entries by id, merges (token, right) by rank."""
    from ..session import scratch_path
    m = _train(c1(spark, sf_dir), "zh")
    path = scratch_path(spark, "tokenizer")
    VO.save_tokenizer(m.vocab_frame(spark), m.merges_frame(spark), path)
    vocab, merges = VO.load_tokenizer(spark, path)
    none = F.lit(None).cast("string")
    return (vocab.select(F.lit("vocab").alias("part"), F.col("id").alias("place"), "token", none.alias("right"))
            .unionByName(merges.select(F.lit("merges").alias("part"), F.col("rank").alias("place"),
                                       F.col("left").alias("token"), "right")))


@register("bpe_encode", C1_EN_WITH + f""", alphabet AS (SELECT DISTINCT unnest(string_split(word, '')) AS ch FROM en_words),
    chars AS (SELECT corpus, pair_id, unnest(string_split(x, '')) AS ch, unnest(range(1, length(x) + 1)) AS i
        FROM (SELECT corpus, pair_id, array_to_string(regexp_extract_all(strip_accents(lower(en)), {WORD_RE_SQL}), '') AS x FROM c1))
    SELECT c1.corpus, c1.pair_id, coalesce(p.pieces, '') AS pieces FROM c1 LEFT JOIN (
        SELECT corpus, pair_id, string_agg(coalesce(a.ch, '<unk>'), '' ORDER BY i) AS pieces
        FROM chars LEFT JOIN alphabet a USING (ch) GROUP BY corpus, pair_id) p USING (corpus, pair_id)""")
def q_bpe_encode(spark, sf_dir):
    """Token strings of every English sentence joined, from its ids: the normalised text without white space,
    characters unseen in training as <unk>."""
    c = c1(spark, sf_dir)
    model = _train(c, "en")
    enc = BP.bpe_encode(c.select("pair_id", "corpus", "en"), "en", model, key=["corpus", "pair_id"])
    return enc.select("corpus", "pair_id", BP.token_strings(spark, model, "ids").alias("pieces"))


@register("bpe_ids")
def q_bpe_ids(spark, sf_dir):
    """The ids of every English sentence under the full model (compared with the public library in tests)."""
    c = c1(spark, sf_dir)
    enc = BP.bpe_encode(c.select("pair_id", "corpus", "en"), "en", _train(c, "en"), key=["corpus", "pair_id"])
    return enc.select("corpus", "pair_id", F.size("ids").alias("n_ids"), ids_str("ids").alias("ids"))


@register("byte_decode", C1_WITH + """SELECT corpus, pair_id, CASE WHEN starts_with(x, ' ') THEN x ELSE ' ' || x END AS text
    FROM (SELECT corpus, pair_id, strip_accents(lower(zh)) AS x FROM c1)""")
def q_byte_decode(spark, sf_dir):
    """F7 then F18 at byte level: the second side under its own model and back from the ids; a normalised sentence
    whose bytes were all seen in training comes back whole, with the space that the pre-tokeniser puts in front."""
    rows = c1(spark, sf_dir)
    model = _train(rows, "zh")
    c = rows.select(F.to_json(F.struct("corpus", "pair_id")).alias("uid"), "zh")
    text = BP.bpe_decode(BP.bpe_encode(c, "zh", model, key="uid"), "ids", model, key="uid")
    k = F.from_json("uid", "corpus string, pair_id bigint")
    return text.select(k["corpus"].alias("corpus"), k["pair_id"].alias("pair_id"), "text")


# ---------------------------------------------------------------------------------------------
# 4. Batches
# ---------------------------------------------------------------------------------------------

from ..functions import arrays as AR  # noqa: E402
from ..operators import batch as BA, metrics as ME  # noqa: E402


def c1_ids(spark, sf_dir, positions: bool = False) -> DataFrame:
    """C1 rows with word ids of both sides (doc vocabulary)."""
    c = c1(spark, sf_dir, positions)
    return EN.word_ids_sides(c, [x for x in c.columns if x not in ("en", "zh")],
                             {"en_ids": TX.pretok_words(F.lower("en")),
                              "zh_ids": TX.pretok_words(F.lower("zh"))},
                             doc_word_vocab(spark, sf_dir))


def c1_batches(spark, sf_dir, size=BA.TRAIN_BATCH) -> DataFrame:
    """Batches by the place in the split that the exact split knows already."""
    return BA.batches_at(c1_ids(spark, sf_dir, positions=True), size)


IDS_CTES = WORD_VOCAB_CTES[:3] + [
    ("c1_toks", f"""SELECT corpus, pair_id, side, unnest(t) AS token, unnest(range(1, len(t) + 1)) AS pos FROM (
        SELECT corpus, pair_id, 0 AS side, regexp_extract_all(lower(en), {WORD_RE_SQL}) AS t FROM c1
        UNION ALL SELECT corpus, pair_id, 1, regexp_extract_all(lower(zh), {WORD_RE_SQL}) FROM c1)"""),
    ("side_ids", """SELECT t.corpus, t.pair_id, t.side, list(coalesce(v.id, 0) ORDER BY t.pos) AS ids
        FROM c1_toks t LEFT JOIN word_vocab v ON v.token = t.token GROUP BY ALL"""),
    ("c1_ids", """SELECT c.corpus, c.pair_id, c.split, k.r,
            coalesce(e.ids, []::INTEGER[]) AS en_ids, coalesce(z.ids, []::INTEGER[]) AS zh_ids
        FROM c1 c JOIN ranked k USING (corpus, pair_id)
        LEFT JOIN side_ids e ON e.corpus = c.corpus AND e.pair_id = c.pair_id AND e.side = 0
        LEFT JOIN side_ids z ON z.corpus = c.corpus AND z.pair_id = c.pair_id AND z.side = 1"""),
    ("b128", """SELECT *, CAST(p // 128 AS BIGINT) AS batch_id, CAST(p % 128 AS INTEGER) AS row_in_batch,
            CAST(ceil(cnt / 128) AS BIGINT) AS n_batches
        FROM (SELECT *, row_number() OVER (PARTITION BY split ORDER BY r) - 1 AS p,
                     count(*) OVER (PARTITION BY split) AS cnt FROM c1_ids)"""),
    ("b512", """SELECT *, CAST(p // 512 AS BIGINT) AS batch_id, CAST(p % 512 AS INTEGER) AS row_in_batch
        FROM (SELECT *, row_number() OVER (PARTITION BY split ORDER BY r) - 1 AS p FROM c1_ids)"""),
    ("wrapped", """SELECT *, [2] || en_ids[1:128] || [3] AS src, [2] || zh_ids[1:128] || [3] AS tgt FROM b128"""),
    ("padded", """SELECT *, src || list_transform(range(ms - len(src)), lambda x: 1) AS psrc,
            tgt || list_transform(range(mt - len(tgt)), lambda x: 1) AS ptgt
        FROM (SELECT *, max(len(src)) OVER (PARTITION BY split, batch_id) AS ms,
                     max(len(tgt)) OVER (PARTITION BY split, batch_id) AS mt FROM wrapped)"""),
]
IDS_WITH = with_inputs("raw_news", "raw_titles", "raw_mined", extra=C1_CTES + IDS_CTES)


def _s(col):
    return ids_str(col)


def _sql_s(x):
    return f"array_to_string({x}, ' ')"


@register("assign_batches", IDS_WITH + "SELECT corpus, pair_id, split, batch_id, row_in_batch, n_batches FROM b128")
def q_assign_batches(spark, sf_dir):
    """By a position of its own (any order and grouping); the other batch keys take the place in the split."""
    rows = c1(spark, sf_dir).withColumn("shuffle_key", splitops.seeded_key(1, "corpus", "pair_id"))
    return BA.assign_batches(rows.drop("en", "zh"), ["shuffle_key", "corpus", "pair_id"]).select(
        "corpus", "pair_id", "split", "batch_id", "row_in_batch", "n_batches")


@register("batches_at", IDS_WITH + "SELECT corpus, pair_id, split, batch_id, row_in_batch, n_batches FROM b128")
def q_batches_at(spark, sf_dir):
    return BA.batches_at(c1(spark, sf_dir, positions=True)).select(
        "corpus", "pair_id", "split", "batch_id", "row_in_batch", "n_batches")


@register("first_k_per_batch", IDS_WITH + "SELECT corpus, pair_id, split, batch_id, row_in_batch FROM b512 "
          "WHERE row_in_batch < 2")
def q_first_k_per_batch(spark, sf_dir):
    b = c1_batches(spark, sf_dir, BA.EVAL_BATCH)
    return BA.first_k_per_batch(b, 2).select("corpus", "pair_id", "split", "batch_id", "row_in_batch")


STEP_SQL = """SELECT CAST(e.epoch AS INTEGER) AS epoch, b.batch_id, e.epoch * b.n_batches + b.batch_id + 1 AS step
    FROM (SELECT DISTINCT batch_id, n_batches FROM b128 WHERE split = 'train') b,
         LATERAL (SELECT unnest(range(0, 5)) AS epoch) e"""


def _train_batches(spark, sf_dir):
    b = c1_batches(spark, sf_dir)
    return b.where((F.col("split") == "train") & (F.col("row_in_batch") == 0)).select("batch_id", "n_batches")


@register("step_schedule", IDS_WITH + STEP_SQL)
def q_step_schedule(spark, sf_dir):
    return BA.step_schedule(_train_batches(spark, sf_dir), epochs=5)


@register("every_nth", IDS_WITH + f"""SELECT epoch, batch_id, step, batch_id % 100 = 0 AS log, step % 10000 = 0 AS save
    FROM ({STEP_SQL}) WHERE batch_id % 100 = 0 OR step % 10000 = 0""")
def q_every_nth(spark, sf_dir):
    return BA.every_nth(BA.step_schedule(_train_batches(spark, sf_dir), epochs=5))


@register("truncate_ids", IDS_WITH + "SELECT corpus, pair_id, array_to_string(en_ids[1:128], ' ') AS ids FROM c1_ids")
def q_truncate_ids(spark, sf_dir):
    return c1_ids(spark, sf_dir).select("corpus", "pair_id", _s(AR.truncate_ids("en_ids")).alias("ids"))


@register("wrap_ids", IDS_WITH + "SELECT corpus, pair_id, array_to_string([2] || zh_ids[1:128] || [3], ' ') AS ids FROM c1_ids")
def q_wrap_ids(spark, sf_dir):
    return c1_ids(spark, sf_dir).select("corpus", "pair_id",
                                        _s(AR.wrap_ids(AR.truncate_ids("zh_ids"))).alias("ids"))


def _padded(spark, sf_dir):
    b = c1_batches(spark, sf_dir)
    x = BA.wrap_and_truncate(BA.wrap_and_truncate(b, "en_ids", "src"), "zh_ids", "tgt")
    return BA.pad_batches(BA.pad_batches(x, "src", out="psrc"), "tgt", out="ptgt")


@register("pad_batches", IDS_WITH + """SELECT corpus, pair_id, split, batch_id, row_in_batch,
        CAST(len(psrc) AS INTEGER) AS n_ids, array_to_string(psrc, ' ') AS ids FROM padded""")
def q_pad_batches(spark, sf_dir):
    return _padded(spark, sf_dir).select("corpus", "pair_id", "split", "batch_id", "row_in_batch",
                                         F.size("psrc").alias("n_ids"), _s("psrc").alias("ids"))


T5_SQL = """SELECT corpus, pair_id,
        array_to_string(ii || list_transform(range(mi - len(ii)), lambda x: 0), ' ') AS input_ids,
        array_to_string(list_transform(range(len(ii)), lambda x: 1) || list_transform(range(mi - len(ii)), lambda x: 0), ' ') AS attention_mask,
        array_to_string(lb || list_transform(range(ml - len(lb)), lambda x: -100), ' ') AS labels
    FROM (SELECT *, max(len(ii)) OVER (PARTITION BY split, batch_id) AS mi,
                 max(len(lb)) OVER (PARTITION BY split, batch_id) AS ml
          FROM (SELECT *, en_ids[1:127] || [1] AS ii, zh_ids[1:127] || [1] AS lb FROM b128))"""


def _t5_batches(spark, sf_dir):
    b = c1_batches(spark, sf_dir)
    eos = F.array(F.lit(AR.T5_EOS_ID))
    b = b.withColumn("ii", F.concat(F.slice("en_ids", 1, 127), eos)) \
        .withColumn("lb", F.concat(F.slice("zh_ids", 1, 127), eos))
    return BA.pad_for_t5(b, "ii", "lb")


@register("pad_labels", IDS_WITH + T5_SQL)
def q_pad_labels(spark, sf_dir):
    return _t5_batches(spark, sf_dir).select("corpus", "pair_id", _s("ii").alias("input_ids"),
                                             _s("attention_mask").alias("attention_mask"),
                                             _s("lb").alias("labels"))


@register("unmask_labels", IDS_WITH + f"""SELECT corpus, pair_id,
        array_to_string(list_transform(string_split(labels, ' '), lambda x: CASE WHEN x = '-100' THEN '0' ELSE x END), ' ') AS labels
    FROM ({T5_SQL})""")
def q_unmask_labels(spark, sf_dir):
    return _t5_batches(spark, sf_dir).select("corpus", "pair_id", _s(AR.unmask_labels("lb")).alias("labels"))


@register("shift_targets", IDS_WITH + """SELECT corpus, pair_id, array_to_string(ptgt[1:len(ptgt) - 1], ' ') AS tgt_in,
        array_to_string(ptgt[2:], ' ') AS tgt_out FROM padded""")
def q_shift_targets(spark, sf_dir):
    p = _padded(spark, sf_dir)
    return p.select("corpus", "pair_id", _s(AR.decoder_input("ptgt")).alias("tgt_in"),
                    _s(AR.decoder_target("ptgt")).alias("tgt_out"))


@register("padding_mask", IDS_WITH + """SELECT corpus, pair_id,
        array_to_string(list_transform(psrc, lambda x: CASE WHEN x = 1 THEN 1 ELSE 0 END), '') AS src_pad_mask,
        CAST(len(psrc) AS INTEGER) AS src_mask_len FROM padded""")
def q_padding_mask(spark, sf_dir):
    p = _padded(spark, sf_dir)
    m = F.transform(AR.padding_mask("psrc"), lambda x: x.cast("int"))
    return p.select("corpus", "pair_id", F.array_join(m.cast("array<string>"), "").alias("src_pad_mask"),
                    F.size(AR.all_false_mask(F.size("psrc"))).alias("src_mask_len"))


@register("causal_mask", IDS_WITH + """SELECT n, array_to_string(flatten(list_transform(range(n), lambda i:
            list_transform(range(n), lambda j: CASE WHEN j <= i THEN 0 ELSE 1 END))), '') AS blocked
    FROM (SELECT DISTINCT n FROM (SELECT CAST(len(ptgt) - 1 AS INTEGER) AS n FROM padded
          UNION ALL SELECT CAST(len(tgt) - 1 AS INTEGER) FROM padded))""")
def q_causal_mask(spark, sf_dir):
    # every decoder-input size in use: the padded batch length and each row's own length
    p = _padded(spark, sf_dir)
    sizes = p.select((F.size("ptgt") - 1).alias("n")).unionByName(
        p.select((F.size("tgt") - 1).alias("n")))
    m = BA.causal_masks(sizes, "n")
    blocked = F.flatten(F.transform("mask", lambda row: F.transform(
        row, lambda v: F.when(v == 0.0, "0").otherwise("1"))))
    return m.select("n", F.array_join(blocked, "").alias("blocked"))


@register("transpose_batch", IDS_WITH + """SELECT split, batch_id, CAST(t - 1 AS INTEGER) AS t,
        array_to_string(list(psrc[t] ORDER BY row_in_batch), ' ') AS ids
    FROM padded, LATERAL (SELECT unnest(range(1, len(psrc) + 1)) AS t) r GROUP BY split, batch_id, t""")
def q_transpose_batch(spark, sf_dir):
    tb = BA.transpose_batches(_padded(spark, sf_dir), "psrc")
    return tb.select("split", "batch_id", "t", _s("ids").alias("ids"))


@register("token_rows", IDS_WITH + """SELECT corpus, pair_id, CAST(t - 1 AS INTEGER) AS t, psrc[t] AS id
    FROM padded, LATERAL (SELECT unnest(range(1, len(psrc) + 1)) AS t) r""")
def q_token_rows(spark, sf_dir):
    return BA.token_rows(_padded(spark, sf_dir), "psrc", ["corpus", "pair_id"])


@register("model_batches", IDS_WITH + """SELECT corpus, pair_id, split, batch_id, row_in_batch,
        array_to_string(psrc, ' ') AS src, array_to_string(ptgt[1:len(ptgt) - 1], ' ') AS tgt_in,
        array_to_string(ptgt[2:], ' ') AS tgt_out,
        CAST(len(list_filter(psrc, lambda x: x = 1)) AS INTEGER) AS n_src_pad FROM padded""")
def q_model_batches(spark, sf_dir):
    m = BA.model_batches(c1_batches(spark, sf_dir), "en_ids", "zh_ids")
    return m.select("corpus", "pair_id", "split", "batch_id", "row_in_batch",
                    _s("en_ids").alias("src"), _s("tgt_in").alias("tgt_in"), _s("tgt_out").alias("tgt_out"),
                    F.size(F.filter("src_pad_mask", lambda x: x)).alias("n_src_pad"))


@register("batch_masks", IDS_WITH + """SELECT split, batch_id, CAST(s AS INTEGER) AS src_len, CAST(t AS INTEGER) AS tgt_len,
        repeat('0', CAST(s * s AS INTEGER)) AS src_mask, array_to_string(flatten(list_transform(range(t), lambda i:
            list_transform(range(t), lambda j: CASE WHEN j <= i THEN 0 ELSE 1 END))), '') AS tgt_mask
    FROM (SELECT split, batch_id, max(len(psrc)) AS s, max(len(ptgt)) - 1 AS t FROM padded GROUP BY split, batch_id)""")
def q_batch_masks(spark, sf_dir):
    m = BA.batch_masks(BA.model_batches(c1_batches(spark, sf_dir), "en_ids", "zh_ids"), "en_ids")

    def bits(mask, blocked):
        return F.array_join(F.transform(F.flatten(mask), lambda v: F.when(blocked(v), "1").otherwise("0")), "")

    return m.select("split", "batch_id", "src_len", "tgt_len", bits("src_mask", lambda v: v).alias("src_mask"),
                    bits("tgt_mask", lambda v: v != 0.0).alias("tgt_mask"))


@register("collate_udf", IDS_WITH + """SELECT corpus, pair_id, split, batch_id, row_in_batch,
        CAST(len(psrc) AS INTEGER) AS n_ids, array_to_string(psrc, ' ') AS ids FROM padded""")
def q_collate_udf(spark, sf_dir):
    b = c1_batches(spark, sf_dir)
    x = BA.wrap_and_truncate(b, "en_ids", "psrc").select("corpus", "pair_id", "split", "batch_id",
                                                          "row_in_batch", "psrc")
    schema = "corpus string, pair_id bigint, split string, batch_id bigint, row_in_batch int, psrc array<int>"
    out = BA.collate_with(x, BA.pad_collate("psrc"), schema)
    return out.select("corpus", "pair_id", "split", "batch_id", "row_in_batch",
                      F.size("psrc").alias("n_ids"), _s("psrc").alias("ids"))


# ---------------------------------------------------------------------------------------------
# 5. Metrics
# ---------------------------------------------------------------------------------------------

LOGITS_NLL_SQL = """SELECT vec_id, batch_id, label,
        ln(list_sum(list_transform(scores, lambda x: exp(x - m)))) + m - scores[label + 1] AS nll
    FROM (SELECT *, list_max(scores) AS m FROM logits)"""


@register("greedy_pick", with_inputs("logits") +
          "SELECT vec_id, CAST(list_position(scores, list_max(scores)) - 1 AS INTEGER) AS pick FROM logits")
def q_greedy_pick(spark, sf_dir):
    return I.logits(spark, sf_dir).select("vec_id", AR.argmax("scores").alias("pick"))


@register("greedy_pick_long", with_inputs("logits") + """SELECT vec_id, arg_max(token, (score, -token)) AS pick
    FROM (SELECT vec_id, CAST(t - 1 AS INTEGER) AS token, scores[t] AS score
          FROM logits, LATERAL (SELECT unnest(range(1, len(scores) + 1)) AS t) r) GROUP BY vec_id""")
def q_greedy_pick_long(spark, sf_dir):
    lg = I.logits(spark, sf_dir).select("vec_id", F.posexplode("scores").alias("token", "score"))
    return ME.greedy_pick_long(lg, ["vec_id"])


@register("log_softmax", with_inputs("logits") + """SELECT vec_id, round(scores[label + 1] - lse, 6) AS logp_label,
        round(list_max(scores) - lse, 6) AS logp_max
    FROM (SELECT *, ln(list_sum(list_transform(scores, lambda x: exp(x - list_max(scores))))) + list_max(scores) AS lse
          FROM logits)""")
def q_log_softmax(spark, sf_dir):
    lg = I.logits(spark, sf_dir).withColumn("lsm", AR.log_softmax("scores"))
    return lg.select("vec_id", F.round(F.element_at("lsm", F.col("label") + 1), 6).alias("logp_label"),
                     F.round(F.array_max("lsm"), 6).alias("logp_max"))


@register("masked_loss", with_inputs("logits", extra=[("nll", LOGITS_NLL_SQL)]) +
          "SELECT batch_id, round(avg(nll), 6) AS loss, count(*) AS n_rows FROM nll WHERE label <> 1 GROUP BY batch_id")
def q_masked_loss(spark, sf_dir):
    ml = ME.masked_loss(I.logits(spark, sf_dir))
    return ml.select("batch_id", F.round("loss", 6).alias("loss"), "n_rows")


@register("eval_loss", with_inputs("logits", extra=[("nll", LOGITS_NLL_SQL), (
    "bl", "SELECT batch_id, avg(nll) AS loss, count(*) AS n_rows FROM nll WHERE label <> 1 GROUP BY batch_id")]) +
    """SELECT round(avg(loss), 6) AS loss_batch_mean, round(sum(loss * n_rows) / sum(n_rows), 6) AS loss_row_mean,
        count(*) AS n_batches FROM bl""")
def q_eval_loss(spark, sf_dir):
    e = ME.eval_loss(ME.masked_loss(I.logits(spark, sf_dir)))
    return e.select(F.round("loss_batch_mean", 6).alias("loss_batch_mean"),
                    F.round("loss_row_mean", 6).alias("loss_row_mean"), "n_batches")


def _ngram_sql(side: str, col: str, keys: str) -> str:
    return f"""SELECT {keys}, n, '{side}' AS side, array_to_string(t[i:i + n - 1], ' ') AS g
        FROM (SELECT {keys}, string_split({col}, ' ') AS t FROM toks WHERE {col} <> '') x,
             LATERAL (SELECT unnest(range(1, 5)) AS n) nn,
             LATERAL (SELECT unnest(range(1, len(x.t) - nn.n + 2)) AS i) ii"""


def bleu_ctes(toks_sql: str, keys: str = "pair_id", by: str = "") -> list[tuple[str, str]]:
    """DuckDB BLEU statistics: ``toks`` must give ``keys, [by,] h, r`` as space-joined tokens."""
    kb = f"{keys}, {by}" if by else keys
    b = f"{by}, " if by else ""
    return [
        ("toks", toks_sql),
        ("grams", f"{_ngram_sql('h', 'h', kb)} UNION ALL {_ngram_sql('r', 'r', kb)}"),
        ("per_gram", f"""SELECT {kb}, n, g, count(*) FILTER (WHERE side = 'h') AS h,
            count(*) FILTER (WHERE side = 'r') AS r FROM grams GROUP BY ALL"""),
        ("stats", f"""SELECT {b}CAST(n AS INTEGER) AS n, CAST(sum(least(h, r)) AS BIGINT) AS matches,
            CAST(sum(h) AS BIGINT) AS total, CAST(sum(r) AS BIGINT) AS ref_total FROM per_gram GROUP BY {b}n"""),
    ]


def corpus_bleu_sql(by: str = "") -> str:
    b = f"{by}, " if by else ""
    group = f" GROUP BY {by}" if by else ""
    sums = ", ".join(
        f"coalesce(sum(matches) FILTER (WHERE n = {n}), 0) AS m{n}, coalesce(sum(total) FILTER (WHERE n = {n}), 0) AS t{n}"
        for n in range(1, 5))
    return f"""SELECT {b}round(CASE WHEN m1 + m2 + m3 + m4 = 0 THEN 0.0 ELSE bp * exp((l1 + l2 + l3 + l4) / 4) END, 6) AS bleu,
        round(bp, 6) AS bp, hyp_len, ref_len FROM (
    SELECT *, CASE WHEN hyp_len >= ref_len THEN 1.0 WHEN hyp_len > 0 THEN exp(1 - ref_len / hyp_len) ELSE 0.0 END AS bp,
        CASE WHEN t1 = 0 THEN -9999999999 WHEN m1 = 0 THEN ln(100.0 / (2 * t1)) ELSE ln(100.0 * m1 / t1) END AS l1,
        CASE WHEN t1 = 0 OR t2 = 0 THEN -9999999999 WHEN m2 = 0 THEN ln(100.0 / (pow(2, z2) * t2)) ELSE ln(100.0 * m2 / t2) END AS l2,
        CASE WHEN t1 = 0 OR t2 = 0 OR t3 = 0 THEN -9999999999 WHEN m3 = 0 THEN ln(100.0 / (pow(2, z3) * t3)) ELSE ln(100.0 * m3 / t3) END AS l3,
        CASE WHEN t1 = 0 OR t2 = 0 OR t3 = 0 OR t4 = 0 THEN -9999999999 WHEN m4 = 0 THEN ln(100.0 / (pow(2, z4) * t4)) ELSE ln(100.0 * m4 / t4) END AS l4
    FROM (SELECT *, (m1 = 0)::INT + (m2 = 0)::INT AS z2, (m1 = 0)::INT + (m2 = 0)::INT + (m3 = 0)::INT AS z3,
                 (m1 = 0)::INT + (m2 = 0)::INT + (m3 = 0)::INT + (m4 = 0)::INT AS z4
          FROM (SELECT {b}{sums},
                       CAST(coalesce(sum(total) FILTER (WHERE n = 1), 0) AS BIGINT) AS hyp_len,
                       CAST(coalesce(sum(ref_total) FILTER (WHERE n = 1), 0) AS BIGINT) AS ref_len FROM stats{group})))"""


BLEU_CTES = bleu_ctes(f"SELECT pair_id, {_zh_tokens_sql('en')} AS h, {_zh_tokens_sql('zh')} AS r FROM bitext")
CORPUS_BLEU_SQL = corpus_bleu_sql()


def _bleu_toks(spark, sf_dir, tok=TX.zh_tokens):
    b = I.bitext(spark, sf_dir)
    return b.select("pair_id", tok(F.col("en")).alias("h"), tok(F.col("zh")).alias("r"))


@register("bleu_stats", with_inputs("bitext", extra=BLEU_CTES) + "SELECT n, matches, total, ref_total FROM stats")
def q_bleu_stats(spark, sf_dir):
    return ME.bleu_stats(_bleu_toks(spark, sf_dir), "h", "r")


@register("corpus_bleu", with_inputs("bitext", extra=BLEU_CTES) + CORPUS_BLEU_SQL)
def q_corpus_bleu(spark, sf_dir):
    b = ME.corpus_bleu(ME.bleu_stats(_bleu_toks(spark, sf_dir), "h", "r"))
    return b.select(F.round("bleu", 6).alias("bleu"), F.round("bp", 6).alias("bp"), "hyp_len", "ref_len")


PLAIN_CTES = bleu_ctes(f"""SELECT pair_id, array_to_string(regexp_extract_all(lower(en), {WORD_RE_SQL}), ' ') AS h,
        array_to_string(regexp_extract_all(lower(zh), {WORD_RE_SQL}), ' ') AS r FROM bitext""")


@register("plain_bleu", with_inputs("bitext", extra=PLAIN_CTES) + """SELECT round(CASE WHEN m1 > 0 AND m2 > 0 AND m3 > 0 AND m4 > 0
            THEN exp((ln(m1 / t1) + ln(m2 / t2) + ln(m3 / t3) + ln(m4 / t4)) / 4) ELSE 0 END
            * CASE WHEN hyp_len / ref_len > 1 THEN 1.0 ELSE exp(1 - ref_len / hyp_len) END, 6) AS bleu,
        round(hyp_len / ref_len, 6) AS ratio, hyp_len, ref_len
    FROM (SELECT sum(matches) FILTER (WHERE n = 1) AS m1, sum(total) FILTER (WHERE n = 1) AS t1,
                 sum(matches) FILTER (WHERE n = 2) AS m2, sum(total) FILTER (WHERE n = 2) AS t2,
                 sum(matches) FILTER (WHERE n = 3) AS m3, sum(total) FILTER (WHERE n = 3) AS t3,
                 sum(matches) FILTER (WHERE n = 4) AS m4, sum(total) FILTER (WHERE n = 4) AS t4,
                 CAST(sum(total) FILTER (WHERE n = 1) AS BIGINT) AS hyp_len, CAST(sum(ref_total) FILTER (WHERE n = 1) AS BIGINT) AS ref_len FROM stats)""")
def q_plain_bleu(spark, sf_dir):
    t = _bleu_toks(spark, sf_dir, lambda c: TX.pretok_words(F.lower(c)))
    p = ME.plain_bleu(ME.bleu_stats(t, "h", "r"))
    return p.select(F.round("bleu", 6).alias("bleu"), F.round("ratio", 6).alias("ratio"), "hyp_len", "ref_len")


@register("cut_eos", IDS_WITH + """SELECT corpus, pair_id, array_to_string((CASE WHEN list_position(l, 3) > 0
        THEN l[1:list_position(l, 3) - 1] ELSE l END)[1:128], ' ') AS ids
    FROM (SELECT corpus, pair_id, en_ids || [3] || zh_ids AS l FROM c1_ids)""")
def q_cut_eos(spark, sf_dir):
    c = c1_ids(spark, sf_dir)
    pred = F.concat("en_ids", F.array(F.lit(3)), "zh_ids")
    return c.select("corpus", "pair_id", _s(AR.truncate_ids(AR.cut_at_eos(pred))).alias("ids"))


@register("empty_refs", IDS_WITH + """SELECT * FROM (SELECT split, batch_id, row_in_batch, ref,
        lag(ref) OVER w AS prev_ref, lead(ref) OVER w AS next_ref
    FROM (SELECT b.split, b.batch_id, b.row_in_batch, coalesce((SELECT string_agg(v.token, ' ' ORDER BY u.i)
            FROM (SELECT unnest(b.zh_ids) AS id, unnest(range(1, len(b.zh_ids) + 1)) AS i) u
            JOIN word_vocab v ON v.id = u.id WHERE u.id > 3), '') AS ref
          FROM b512 b) x
    WINDOW w AS (PARTITION BY split, batch_id ORDER BY row_in_batch)) WHERE length(trim(ref)) = 0""")
def q_empty_refs(spark, sf_dir):
    b = c1_batches(spark, sf_dir, BA.EVAL_BATCH)
    dec = EN.decode_ids(b.select(F.struct("split", "batch_id", "row_in_batch").alias("k"), "zh_ids"), "zh_ids",
                        doc_word_vocab(spark, sf_dir), key="k", out="ref")
    d = dec.select("k.split", "k.batch_id", "k.row_in_batch", "ref")
    return clean.empty_refs(d, ref="ref", batch=("split", "batch_id"), pos="row_in_batch")


@register("empty_raw_refs", with_inputs("raw_bad") + f"""SELECT * FROM (SELECT batch_id, pos, ref, lag(ref) OVER w AS prev_ref, lead(ref) OVER w AS next_ref
    FROM (SELECT row_number() OVER (ORDER BY pair_id) - 1 AS pos, pos // 512 AS batch_id, f[2] AS ref
          FROM {_split_sql('raw_bad')} WHERE len(f) = 2)
    WINDOW w AS (PARTITION BY batch_id ORDER BY pos)) WHERE length({sql_strip('ref')}) = 0""")
def q_empty_raw_refs(spark, sf_dir):
    """P10 / W2 before any cleaning: the raw second sides, some of them blank, in batches by position."""
    raw = tsv.read_pairs(I.raw_bad(spark, sf_dir), mode="DROPMALFORMED")
    pos = splitops.dense_position(raw.select("pair_id", F.col("zh").alias("ref")), ["pair_id"], out="pos")
    pos = pos.select(F.floor(F.col("pos") / BA.EVAL_BATCH).cast("bigint").alias("batch_id"), F.col("pos").cast("bigint"), "ref")
    return clean.empty_refs(pos, ref="ref", batch="batch_id", pos="pos")


@register("scoreboard", with_inputs("labels_long") + """SELECT k.split, k.metric, m.model, round(l.value, 4) AS value
    FROM (SELECT DISTINCT split, metric FROM labels_long) k CROSS JOIN
        (SELECT DISTINCT model FROM labels_long WHERE model IS NOT NULL) m
    LEFT JOIN labels_long l ON l.split = k.split AND l.metric = k.metric AND l.model = m.model""")
def q_scoreboard(spark, sf_dir):
    """The board over all models of the table, its cells as rows (a missing cell is null)."""
    board = ME.scoreboard(I.labels_long(spark, sf_dir))
    models = [F.col(f"`{m}`") for m in board.columns if m not in ("split", "metric")]
    return board.unpivot(["split", "metric"], models, "model", "value")


EVAL_SQL_BODY = """SELECT 'copy' AS model, 'all' AS split, 'bleu' AS metric, bleu AS value FROM cb
    UNION ALL SELECT 'copy', 'all', 'hyp_len', CAST(hyp_len AS DOUBLE) FROM cb
    UNION ALL SELECT 'copy', 'all', 'ref_len', CAST(ref_len AS DOUBLE) FROM cb
    UNION ALL SELECT 'copy', 'all', 'loss', round(avg(loss), 6) FROM bl"""


@register("evaluate", with_inputs("bitext", "logits", extra=BLEU_CTES + [
    ("cb", CORPUS_BLEU_SQL), ("nll", LOGITS_NLL_SQL),
    ("bl", "SELECT batch_id, avg(nll) AS loss, count(*) AS n_rows FROM nll WHERE label <> 1 GROUP BY batch_id")]) + EVAL_SQL_BODY)
def q_evaluate(spark, sf_dir):
    b = I.bitext(spark, sf_dir)
    losses = ME.masked_loss(I.logits(spark, sf_dir))
    rep = ME.evaluate(b.select("pair_id", F.col("en").alias("pred")), b.select("pair_id", F.col("zh").alias("ref")),
                      TX.zh_tokens, losses=losses, model="copy")
    return rep.select("model", "split", "metric", F.round("value", 6).alias("value"))


EVAL_IDS_CTES = [
    ("sampled", "SELECT corpus || ':' || CAST(pair_id AS VARCHAR) AS uid, split, en_ids || [3] || zh_ids AS p, zh_ids AS r "
                "FROM b512 WHERE row_in_batch < 2"),
    ("id_rows", """SELECT uid, 'h' AS side, unnest(ids) AS id, unnest(range(1, len(ids) + 1)) AS at
            FROM (SELECT uid, p[1:list_position(p, 3) - 1] AS ids FROM sampled)
        UNION ALL SELECT uid, 'r', unnest(r), unnest(range(1, len(r) + 1)) FROM sampled"""),
    ("spelled", """SELECT uid, side, string_agg(v.token, ' ' ORDER BY i.at) AS text
        FROM id_rows i JOIN word_vocab v ON v.id = i.id WHERE i.id > 3 GROUP BY uid, side"""),
    ("texts", """SELECT s.uid, s.split, coalesce(h.text, '') AS ht, coalesce(r.text, '') AS rt FROM sampled s
        LEFT JOIN spelled h ON h.uid = s.uid AND h.side = 'h' LEFT JOIN spelled r ON r.uid = s.uid AND r.side = 'r'"""),
] + bleu_ctes(f"SELECT uid, split, {_zh_tokens_sql(_cleanup_sql('ht'))} AS h, {_zh_tokens_sql(_cleanup_sql('rt'))} AS r FROM texts",
              keys="uid", by="split") + [
    ("cb", corpus_bleu_sql("split")), ("nll", LOGITS_NLL_SQL),
    ("split_losses", """SELECT split, avg(nll) AS loss FROM (SELECT *, CASE WHEN b < 200 THEN 'test' WHEN b < 300 THEN 'val' ELSE 'train' END AS split
            FROM (SELECT *, ('0x' || substr(md5('1:' || CAST(vec_id AS VARCHAR)), 1, 8))::BIGINT % 1000 AS b FROM nll))
        WHERE label <> 1 GROUP BY split, batch_id""")]


@register("evaluate_ids", with_inputs("raw_news", "raw_titles", "raw_mined", "logits", extra=C1_CTES + IDS_CTES + EVAL_IDS_CTES) +
    """SELECT 'ids' AS model, split, 'bleu' AS metric, bleu AS value FROM cb
    UNION ALL SELECT 'ids', split, 'hyp_len', CAST(hyp_len AS DOUBLE) FROM cb
    UNION ALL SELECT 'ids', split, 'ref_len', CAST(ref_len AS DOUBLE) FROM cb
    UNION ALL SELECT 'ids', split, 'loss', round(avg(loss), 6) FROM split_losses GROUP BY split""")
def q_evaluate_ids(spark, sf_dir):
    """C5 from ids: the first rows of every batch, predictions cut at their end, both sides decoded and cleaned up,
    BLEU and loss per split."""
    b = c1_batches(spark, sf_dir, BA.EVAL_BATCH).select(
        F.concat_ws(":", "corpus", "pair_id").alias("uid"), "split", "batch_id", "row_in_batch",
        F.concat("en_ids", F.array(F.lit(AR.EOS_ID)), "zh_ids").alias("pred_ids"), F.col("zh_ids").alias("ref_ids"))
    scores = splitops.hash_split(I.logits(spark, sf_dir), ["vec_id"])
    losses = ME.masked_loss(scores, batch=["split", "batch_id"])
    rep = ME.evaluate_ids(b, "pred_ids", "ref_ids", doc_word_vocab(spark, sf_dir), TX.zh_tokens, key="uid", by=["split"],
                          cut_eos=True, first_k=2, cleanup=True, losses=losses, model="ids")
    return rep.select("model", "split", "metric", F.round("value", 6).alias("value"))


REPORT_CTES = bleu_ctes(f"SELECT corpus, pair_id, split, {_zh_tokens_sql('en')} AS h, {_zh_tokens_sql('zh')} AS r FROM c1",
                        keys="corpus, pair_id", by="split") + [("cb", corpus_bleu_sql("split"))]


@register("eval_report", with_inputs("raw_news", "raw_titles", "raw_mined", extra=C1_CTES + REPORT_CTES) +
    """SELECT 'copy' AS model, split, 'bleu' AS metric, bleu AS value FROM cb
    UNION ALL SELECT 'copy', split, 'hyp_len', CAST(hyp_len AS DOUBLE) FROM cb
    UNION ALL SELECT 'copy', split, 'ref_len', CAST(ref_len AS DOUBLE) FROM cb""")
def q_eval_report(spark, sf_dir):
    c = c1(spark, sf_dir)
    rep = ME.evaluate(c.select("corpus", "pair_id", "split", F.col("en").alias("pred")),
                      c.select("corpus", "pair_id", F.col("zh").alias("ref")),
                      TX.zh_tokens, key=["corpus", "pair_id"], by=["split"], model="copy")
    return rep.select("model", "split", "metric", F.round("value", 6).alias("value"))


# ---------------------------------------------------------------------------------------------
# 6. Logs
# ---------------------------------------------------------------------------------------------

from ..functions import logs as LG  # noqa: E402
from ..operators import logs as LO  # noqa: E402
from ..session import scratch_path  # noqa: E402

LOSS_RE_SQL = r"'^batch loss at \d+ = (\d+\.?\d+?)'"
LOG_CTES = [
    ("lines", "SELECT 'RNN' AS model, seq, value, false AS d FROM log_own "
              "UNION ALL SELECT 'MT5 finetune', seq, value, true FROM log_trainer"),
    ("parsed", f"""SELECT model, seq, CASE WHEN d THEN (CASE WHEN contains(value, '''loss''')
            THEN CAST(json_extract(replace(value, '''', '"'), '$.loss') AS DOUBLE) END)
        ELSE CAST(nullif(regexp_extract(value, {LOSS_RE_SQL}, 1), '') AS DOUBLE) END AS loss FROM lines"""),
    ("kept", "SELECT * FROM parsed WHERE loss IS NOT NULL AND loss <> 0"),
]
LOG_WITH = with_inputs("log_own", "log_trainer", extra=LOG_CTES)


@register("loss_lines", LOG_WITH + "SELECT seq, loss FROM parsed WHERE model = 'RNN' AND loss IS NOT NULL")
def q_loss_lines(spark, sf_dir):
    l = I.log_own(spark, sf_dir).select("seq", LG.loss_from_line("value").alias("loss"))
    return l.where(F.col("loss").isNotNull())


@register("loss_dicts", LOG_WITH + "SELECT seq, loss FROM parsed WHERE model <> 'RNN' AND loss IS NOT NULL")
def q_loss_dicts(spark, sf_dir):
    l = I.log_trainer(spark, sf_dir).select("seq", LG.loss_from_dict("value").alias("loss"))
    return l.where(F.col("loss").isNotNull())


def write_logs(spark, sf_dir) -> dict[str, str]:
    """The two logs as text files in the shared folder, named like the reference's."""
    base = scratch_path(spark, "logs")
    files = {"RNN": f"{base}/output-rnn-orthogonal.log", "MT5 finetune": f"{base}/output-mt5.log"}
    for (legend, path), frame in zip(files.items(), (I.log_own(spark, sf_dir), I.log_trainer(spark, sf_dir))):
        frame.orderBy("seq").select("value").write.text(path)
    return files


@register("log_series", LOG_WITH + """SELECT model, row_number() OVER w - 1 AS idx,
        round(CASE WHEN count(*) OVER p > 1 THEN 5.0 * (row_number() OVER w - 1) / (count(*) OVER p - 1) ELSE 0.0 END, 6) AS epoch,
        loss FROM kept WINDOW w AS (PARTITION BY model ORDER BY seq), p AS (PARTITION BY model)""")
def q_log_series(spark, sf_dir):
    s = LO.log_series(spark, write_logs(spark, sf_dir))
    return s.select("model", "idx", F.round("epoch", 6).alias("epoch"), "loss")


# ---------------------------------------------------------------------------------------------
# 7b. Remaining filters and joins
# ---------------------------------------------------------------------------------------------

MINED_SQL = (f"SELECT pair_id, CAST(f[1] AS DOUBLE) AS score, f[2] AS en, f[3] AS zh, f[4] AS from_lang, "
             f"f[5] AS to_lang FROM {_split_sql('raw_mined')}")
MARGIN = 1.10
# fixed value: the task prefix of the pre-trained model
TASK_PREFIX = "translate English to Chinese: "


@register("convert_where", with_inputs("raw_mined") + f"""SELECT pair_id, CASE WHEN to_lang <> 'zh-Hans'
        THEN translate(zh, '{T2S_FROM}', '{T2S_TO}') ELSE zh END AS zh, to_lang FROM ({MINED_SQL})""")
def q_convert_where(spark, sf_dir):
    m = tsv.read_mined(I.raw_mined(spark, sf_dir))
    return clean.convert_where(m, mode="non_simplified", chars=SAMPLE_T2S_CHARS).select("pair_id", "zh", "to_lang")


@register("convert_where_phrases", with_inputs("bitext", "raw_mined", extra=[*PHRASE_CTES, ("mined", MINED_SQL)]) +
          """SELECT pair_id, CASE WHEN to_lang <> 'zh-Hans' THEN coalesce(array_to_string(list_transform(
        regexp_extract_all(zh, p), lambda x: coalesce(m[x], x)), ''), '') ELSE zh END AS zh, to_lang FROM mined, pattern, dict""")
def q_convert_where_phrases(spark, sf_dir):
    """P3 with a phrase dictionary made from the table, which meets the texts (both values of the tag occur)."""
    m = tsv.read_mined(I.raw_mined(spark, sf_dir))
    return clean.convert_where(m, mode="non_simplified", chars={}, phrases=phrase_table(spark, sf_dir)).select(
        "pair_id", "zh", "to_lang")


@register("prefix_source", with_inputs("bitext") + f"SELECT pair_id, '{TASK_PREFIX}' || en AS en FROM bitext")
def q_prefix_source(spark, sf_dir):
    return clean.prefix_source(I.bitext(spark, sf_dir), TASK_PREFIX).select("pair_id", "en")


@register("margin_filter", with_inputs("raw_mined") + f"SELECT pair_id, score, en, zh FROM ({MINED_SQL}) WHERE score >= {MARGIN}")
def q_margin_filter(spark, sf_dir):
    m = tsv.read_mined(I.raw_mined(spark, sf_dir))
    return clean.margin_filter(m, MARGIN).select("pair_id", "score", "en", "zh")


def _sides(spark, sf_dir):
    c = c1(spark, sf_dir).withColumn("uid", F.concat_ws(":", "corpus", "pair_id"))
    vocab = doc_word_vocab(spark, sf_dir)
    en = EN.word_ids(c.select("uid", TX.pretok_words(F.lower("en")).alias("t")), "t", vocab, key="uid", out="en_ids")
    zh = EN.word_ids(c.select("uid", TX.pretok_words(F.lower("zh")).alias("t")), "t", vocab, key="uid", out="zh_ids")
    return en, zh


@register("pair_sides", IDS_WITH + """SELECT corpus || ':' || CAST(pair_id AS VARCHAR) AS uid,
        CAST(len(en_ids) AS INTEGER) AS n_en, CAST(len(zh_ids) AS INTEGER) AS n_zh FROM c1_ids""")
def q_pair_sides(spark, sf_dir):
    from ..operators.pairing import pair_sides
    en, zh = _sides(spark, sf_dir)
    return pair_sides(en, zh, "uid").select("uid", F.size("en_ids").alias("n_en"),
                                            F.size("zh_ids").alias("n_zh"))


@register("unmatched_sides", IDS_WITH + """SELECT corpus || ':' || CAST(pair_id AS VARCHAR) AS uid,
        false AS has_en, false AS has_zh FROM c1_ids WHERE false""")
def q_unmatched_sides(spark, sf_dir):
    from ..operators.pairing import unmatched_sides
    en, zh = _sides(spark, sf_dir)
    return unmatched_sides(en, zh, "en", "zh", key="uid")


@register("unmatched_turns", """SELECT coalesce(a.uid, u.uid) AS uid, a.uid IS NOT NULL AS has_en, u.uid IS NOT NULL AS has_zh
    FROM (SELECT conv_id || ':' || turn AS uid FROM conversations WHERE role = 'assistant') a
    FULL JOIN (SELECT conv_id || ':' || (turn - 1) AS uid FROM conversations WHERE role = 'user') u ON a.uid = u.uid
    WHERE a.uid IS NULL OR u.uid IS NULL""")
def q_unmatched_turns(spark, sf_dir):
    """J1's check on sides that do not meet: assistant turns without a user turn after them, and the reverse."""
    from ..operators.pairing import unmatched_sides
    t = I.read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    en = t.where("role = 'assistant'").select(F.concat_ws(":", "conv_id", "turn").alias("uid"))
    zh = t.where("role = 'user'").select(F.concat_ws(":", "conv_id", F.col("turn") - 1).alias("uid"))
    return unmatched_sides(en, zh, "en", "zh", key="uid")


# ---------------------------------------------------------------------------------------------
# 10. Sinks and split files
# ---------------------------------------------------------------------------------------------

from ..sources import encoded as ENC  # noqa: E402


@register("sink_pairs_tsv", with_inputs("bitext") + "SELECT en, zh FROM bitext")
def q_sink_pairs_tsv(spark, sf_dir):
    path = scratch_path(spark, "pairs-tsv")
    tsv.write_pairs_tsv(I.bitext(spark, sf_dir), path)
    return tsv.read_pairs(tsv.read_text_lines(spark, path)).select("en", "zh")


def _write_splits(spark, sf_dir) -> str:
    path = scratch_path(spark, "encoded")
    ENC.write_encoded(c1_ids(spark, sf_dir), path, model="word")
    return path


@register("sink_encoded", IDS_WITH + """SELECT 'word' AS model, split, count(*) AS n_rows,
        CAST(sum(len(en_ids)) AS BIGINT) AS n_en_ids, CAST(sum(len(zh_ids)) AS BIGINT) AS n_zh_ids FROM c1_ids GROUP BY split""")
def q_sink_encoded(spark, sf_dir):
    back = spark.read.parquet(_write_splits(spark, sf_dir))
    return back.groupBy("model", "split").agg(F.count(F.lit(1)).alias("n_rows"),
                                               F.sum(F.size("en_ids")).alias("n_en_ids"),
                                               F.sum(F.size("zh_ids")).alias("n_zh_ids"))


@register("load_split", IDS_WITH + """SELECT corpus, pair_id, CAST(len(en_ids) AS INTEGER) AS n_en,
        CAST(len(zh_ids) AS INTEGER) AS n_zh FROM c1_ids WHERE split = 'val'""")
def q_load_split(spark, sf_dir):
    v = ENC.load_split(spark, _write_splits(spark, sf_dir), "eval", model="word")
    return v.select("corpus", "pair_id", F.size("en_ids").alias("n_en"), F.size("zh_ids").alias("n_zh"))


# ---------------------------------------------------------------------------------------------
# 9. Streaming and batched scoring
# ---------------------------------------------------------------------------------------------

from ..operators import scoring as SC, unigram as UG  # noqa: E402
from ..streaming import streams as ST  # noqa: E402


STREAM_BLOCK = 8 << 20       # bytes of a row group: a trigger's few files are read by many tasks


def _stream_dir(spark, frame: DataFrame, name: str) -> tuple[str, str]:
    """Land a frame as files of a streaming source; returns (source dir, schema DDL)."""
    path = scratch_path(spark, name)
    frame.write.option("parquet.block.size", STREAM_BLOCK).parquet(path)
    return path, frame.schema.simpleString()[len("struct<"):-1].replace(":", " ")


def _run(spark, stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    out, ckpt = scratch_path(spark, name + "-out"), scratch_path(spark, name + "-ckpt")
    ST.run_to_parquet(stream, out, ckpt, mode)
    return spark.read.parquet(out)


@register("stream_clean", with_inputs("raw_bad") + f"""SELECT pair_id, en, zh, CASE WHEN b < 200 THEN 'test'
        WHEN b < 300 THEN 'val' ELSE 'train' END AS split
    FROM (SELECT pair_id, {sql_strip('f[1]')} AS en, {sql_strip('f[2]')} AS zh,
                 ('0x' || substr(md5('1:' || CAST(pair_id AS VARCHAR)), 1, 8))::BIGINT % 1000 AS b
          FROM {_split_sql('raw_bad')} WHERE len(f) = 2) WHERE length(en) > 0 AND length(zh) > 0""")
def q_stream_clean(spark, sf_dir):
    src, schema = _stream_dir(spark, I.raw_bad(spark, sf_dir), "raw-lines")
    lines = spark.readStream.schema(schema).parquet(src)
    return _run(spark, ST.clean_stream(lines), "clean").select("pair_id", "en", "zh", "split")


@register("stream_encode", WORD_WITH + """SELECT pair_id, array_to_string([2] || ids[1:128] || [3], ' ') AS ids FROM en_ids""")
def q_stream_encode(spark, sf_dir):
    src, schema = _stream_dir(spark, I.bitext(spark, sf_dir).select("pair_id", F.col("en").alias("text")),
                              "sentences")
    sentences = spark.readStream.schema(schema).parquet(src)
    out = _run(spark, ST.encode_stream(sentences, doc_word_vocab(spark, sf_dir)), "encode")
    return out.select("pair_id", _s("ids").alias("ids"))


@register("stream_losses", LOG_WITH + """SELECT CASE WHEN model = 'RNN' THEN 'rnn' ELSE 'mt5' END AS log, loss FROM kept""")
def q_stream_losses(spark, sf_dir):
    files = write_logs(spark, sf_dir)
    lines = spark.readStream.text([p for p in files.values()][0].rsplit("/", 1)[0] + "/*/")
    lines = lines.select(F.col("_metadata.file_path").alias("file"), "value")
    out = _run(spark, ST.loss_stream(lines), "losses")
    return out.select(F.when(F.col("file").contains("mt5"), "mt5").otherwise("rnn").alias("log"), "loss")


@register("stream_bleu_stats", with_inputs("bitext", extra=BLEU_CTES) + "SELECT n, matches, total, ref_total FROM stats")
def q_stream_bleu_stats(spark, sf_dir):
    src, schema = _stream_dir(spark, I.bitext(spark, sf_dir), "bleu-rows")
    rows = spark.readStream.schema(schema).parquet(src)
    toks = rows.select(TX.zh_tokens(F.col("en")).alias("h"), TX.zh_tokens(F.col("zh")).alias("r"))
    out = _run(spark, ST.bleu_stats_stream(toks, "h", "r"), "bleu", mode="complete")
    return out.select(F.col("n").cast("int").alias("n"), "matches", "total", "ref_total")


@register("parallel_decode", WORD_WITH + """SELECT b.pair_id, coalesce(string_agg(v.token, ' ' ORDER BY t.pos)
        FILTER (WHERE v.id > 3), '') AS text
    FROM bitext b LEFT JOIN en_toks t ON t.pair_id = b.pair_id LEFT JOIN word_vocab v ON v.token = t.token
    GROUP BY b.pair_id""")
def q_parallel_decode(spark, sf_dir):
    return SC.parallel_decode(bitext_word_ids(spark, sf_dir), "ids", doc_word_vocab(spark, sf_dir))


PRED_VOCAB = 30_000


@register("predict_batches", IDS_WITH + f"""SELECT corpus, pair_id, array_to_string(list_transform(p,
        lambda x: CASE WHEN x < 4 THEN x ELSE (x * 7 + 3) % {PRED_VOCAB} END), ' ') AS pred
    FROM (SELECT corpus, pair_id, src || list_transform(range(130 - len(src)), lambda x: 1) AS p FROM wrapped)""")
def q_predict_batches(spark, sf_dir):
    b = c1_batches(spark, sf_dir)
    x = BA.wrap_and_truncate(b, "en_ids", "src").withColumn("src", AR.pad_to(F.col("src"), F.lit(130)))
    p = SC.predict_batches(x, "src", SC.substitution_predictor(PRED_VOCAB), seq_len=130,
                           batch_size=BA.GENERATE_BATCH)
    return p.select("corpus", "pair_id", _s("pred").alias("pred"))


def _doc_pieces(spark, sf_dir):
    docs = read_table_cols(spark, sf_dir, "documents", "text")
    counts = VO.word_counts(docs, TX.py_split_ws(F.col("text")))
    return UG.pieces_from_counts(counts)


PY_WORD_SQL = "[^" + "".join(f"\\x{{{ord(c):x}}}" for c in TX.PY_WHITESPACE) + "]+"
UNK_PENALTY_SQL = int(UG.UNK_PENALTY)
PIECE_CTES = [
    ("doc_counts", f"""SELECT w, count(*) AS c FROM (SELECT unnest(regexp_extract_all(text, '{PY_WORD_SQL}')) AS w
        FROM documents) GROUP BY w"""),
    ("piece_counts", """SELECT piece, sum(c) AS c FROM (
        SELECT '▁' || w AS piece, c FROM doc_counts WHERE c >= 4
        UNION ALL SELECT unnest([ch, '▁' || ch]) AS piece, c
            FROM (SELECT unnest(string_split(w, '')) AS ch, c FROM doc_counts)) GROUP BY piece"""),
    ("pieces", """SELECT piece, score, CAST(row_number() OVER (ORDER BY score DESC, piece) + 2 AS INTEGER) AS id
        FROM (SELECT piece, round(ln(c) - ln((SELECT sum(c) FROM doc_counts)), 6) AS score FROM piece_counts)"""),
    ("sides", """SELECT 'en' AS lang, pair_id, en AS x FROM {source} UNION ALL SELECT 'zh', pair_id, zh FROM {source}"""),
    ("side_words", """SELECT lang, pair_id, '▁' || w AS w, i FROM (SELECT lang, pair_id, unnest(l) AS w, unnest(range(len(l))) AS i
        FROM (SELECT lang, pair_id, regexp_extract_all(nfc_normalize(x), '\\S+') AS l FROM sides))"""),
    ("todo", "SELECT DISTINCT w FROM side_words"),
    ("arcs", f"""SELECT w, s, s + n AS e, id, score FROM (
            SELECT w, unnest(range(length(w))) AS s FROM todo) t, LATERAL (SELECT unnest(range(1, length(t.w) - t.s + 1)) AS n) u
            JOIN pieces ON piece = substr(w, s + 1, n)
        UNION ALL
        SELECT w, s, s + 1, 2, (SELECT min(score) FROM pieces) - {UNK_PENALTY_SQL} FROM (
            SELECT w, unnest(range(length(w))) AS s FROM todo) t
        WHERE NOT EXISTS (SELECT 1 FROM pieces WHERE piece = substr(w, s + 1, 1))"""),
    ("paths", """SELECT w, 0 AS e, [0.0::DOUBLE] AS best, [[]::INTEGER[]] AS ids FROM todo
        UNION ALL
        SELECT p.w, p.e + 1, list_append(p.best, x.score), list_append(p.ids, x.ids)
        FROM paths p JOIN LATERAL (
            SELECT max(p.best[a.s + 1] + a.score) AS score,
                   arg_max(list_append(p.ids[a.s + 1], a.id), (p.best[a.s + 1] + a.score, -a.s)) AS ids
            FROM arcs a WHERE a.w = p.w AND a.e = p.e + 1) x ON true
        WHERE p.e < length(p.w)"""),
    ("word_pieces", """SELECT w, list_filter(ids[e + 1], lambda x, i: x <> 2 OR i = 1 OR ids[e + 1][i - 1] <> 2) AS ids
        FROM paths WHERE e = length(w)"""),
    ("coded", """SELECT s.lang, s.pair_id, coalesce(t.ids, []::INTEGER[])[1:127] || [1] AS ids FROM sides s LEFT JOIN (
        SELECT lang, pair_id, flatten(list(p.ids ORDER BY i)) AS ids FROM side_words JOIN word_pieces p USING (w)
        GROUP BY lang, pair_id) t USING (lang, pair_id)"""),
]


def piece_ctes(source: str) -> list[tuple[str, str]]:
    return [(n, sql.format(source=source) if n == "sides" else sql) for n, sql in PIECE_CTES]


@register("unigram_encode", with_inputs("bitext", extra=piece_ctes("bitext")).replace("WITH ", "WITH RECURSIVE ", 1) + """SELECT lang,
    pair_id, CAST(len(ids) AS INTEGER) AS n_ids, array_to_string(ids, ' ') AS input_ids, CAST(len(ids) AS INTEGER) AS n_mask
    FROM coded""")
def q_unigram_encode(spark, sf_dir):
    """Both sides of every pair, encoded with the pieces of the documents."""
    b, pieces = I.bitext(spark, sf_dir), _doc_pieces(spark, sf_dir).persist()
    enc = UG.unigram_encoder(spark, pieces)
    sides = [UG.unigram_encode(b, lang, pieces, encoder=enc).withColumn("lang", F.lit(lang)) for lang in ("en", "zh")]
    e = sides[0].unionByName(sides[1])
    return e.select("lang", "pair_id", F.size("input_ids").alias("n_ids"), _s("input_ids").alias("input_ids"),
                    F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).alias("n_mask"))


@register("encode_bitext")
def q_encode_bitext(spark, sf_dir):
    rows = c1(spark, sf_dir)
    en_model, zh_model = _train(rows, "en"), _train(rows, "zh")
    c = rows.withColumn("uid", F.concat_ws(":", "corpus", "pair_id"))
    en = BP.bpe_encode(c, "en", en_model, key=["uid", "split", "zh"], out="en_ids")
    both = BP.bpe_encode(en, "zh", zh_model, key=["uid", "split", "en_ids"], out="zh_ids")
    return both.select("uid", "split", F.size("en_ids").alias("n_en"), F.size("zh_ids").alias("n_zh"),
                       ids_str("en_ids").alias("en_ids"), ids_str("zh_ids").alias("zh_ids"))


from . import pipelines as PL  # noqa: E402
from ..sources import store  # noqa: E402


@register("bpe_published")
def q_bpe_published(spark, sf_dir):
    """C2 written and read back: every split of the published version with the ids of both sides."""
    base = scratch_path(spark, "bpe-store")
    PL.encode_bitext_bpe(c1(spark, sf_dir), base)
    splits = [store.load_published(spark, base, typ) for typ in ("train", "eval", "test")]
    return splits[0].unionByName(splits[1]).unionByName(splits[2]).select(
        "corpus", "pair_id", "split", F.size("en_ids").alias("n_en"), F.size("zh_ids").alias("n_zh"),
        ids_str("en_ids").alias("en_ids"), ids_str("zh_ids").alias("zh_ids"))


C1_KEYED = ("c1_keyed", "SELECT corpus || ':' || CAST(pair_id AS VARCHAR) AS pair_id, en, zh, split FROM c1")


@register("pieces_published", with_inputs("raw_news", "raw_titles", "raw_mined", extra=[*C1_CTES, C1_KEYED, *piece_ctes("c1_keyed")])
          .replace("WITH ", "WITH RECURSIVE ", 1) + """SELECT k.pair_id AS uid, k.split, array_to_string(e.ids, ' ') AS en_ids,
    array_to_string(z.ids, ' ') AS zh_ids FROM c1_keyed k JOIN coded e ON e.pair_id = k.pair_id AND e.lang = 'en'
    JOIN coded z ON z.pair_id = k.pair_id AND z.lang = 'zh' WHERE k.split IN ('val', 'test')""")
def q_pieces_published(spark, sf_dir):
    """C3 written and read back: the val and test splits of the published version, both sides."""
    base = scratch_path(spark, "pieces-store")
    PL.encode_bitext_pieces(c1(spark, sf_dir), base, _doc_pieces(spark, sf_dir))
    both = store.load_published(spark, base, "eval").unionByName(store.load_published(spark, base, "test"))
    return both.select(F.concat_ws(":", "corpus", "pair_id").alias("uid"), "split", ids_str("en_ids").alias("en_ids"),
                       ids_str("zh_ids").alias("zh_ids"))


@register("stream_bpe_encode", ORACLES["bpe_encode"])
def q_stream_bpe_encode(spark, sf_dir):
    """ST1 with the full BPE model: token strings of every English sentence joined, from the ids the stream wrote."""
    base, out = scratch_path(spark, "stream-model"), scratch_path(spark, "stream-ids")
    rows = c1(spark, sf_dir, sides=["en"])          # written once by the split
    model = BP.train_bpe(rows.where("split = 'train'"), "en", "en")
    store.publish_encoded(spark, base, {"en_vocab": model.vocab_frame(spark), "en_merges": model.merges_frame(spark)})
    src, schema = _stream_dir(spark, rows.drop("split"), "stream-sentences")
    sentences = spark.readStream.schema(schema).option("maxFilesPerTrigger", 4).parquet(src)
    ST.encode_bpe_stream(sentences, base, "en", out, scratch_path(spark, "stream-ckpt"), text="en", key=("corpus", "pair_id"))
    return spark.read.parquet(out).select("corpus", "pair_id", BP.token_strings(spark, model, "ids").alias("pieces"))
