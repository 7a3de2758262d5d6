"""Inputs derived from the driver's tables, built the same way in Spark and in DuckDB SQL.

Each builder reads whole tables; the SQL strings define the same relations as CTEs so the oracle
queries can say ``WITH <inputs> SELECT ...``.  Everything here is a projection, an explode or an
equi-join on unique keys, so nothing is skewed by a hot conversation or document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import PY_WHITESPACE
from ..session import read_table

BAD_LINES = [  # extra malformed rows appended to the news lines (P2, P4)
    (-1, "only one field"),
    (-2, "a\tb\tc"),
    (-3, "left side\t   "),
    (-4, "　\tright side"),
]
LINE_PAIR_STRIDE = 1_000_000   # pair_id of a line pair = doc_id * stride + pos
BATCH_LOGITS = 128             # rows per loss batch of the ``logits`` input


def _nl_to_space(c):
    return F.regexp_replace(F.col(c), "\n", " ")


def _turn_pairs(spark, sf_dir, first_role, second_role) -> DataFrame:
    conv = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    a = conv.where(F.col("role") == first_role).select("conv_id", "turn", F.col("text").alias("en"))
    b = conv.where(F.col("role") == second_role).select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("zh"))
    return a.join(b, ["conv_id", "turn"]).select(
        (F.col("conv_id") * 100 + F.col("turn")).alias("pair_id"),
        _nl_to_space("en").alias("en"), _nl_to_space("zh").alias("zh"))


def bitext(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user turn and the assistant turn after it: ``pair_id, en, zh``."""
    return _turn_pairs(spark, sf_dir, "user", "assistant")


def mined_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An assistant turn and the user turn after it (the third corpus)."""
    return _turn_pairs(spark, sf_dir, "assistant", "user")


def doc_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, pos, line``: every line of every document (no shuffle)."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return docs.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))


def line_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each line with the next line of the same document, paired inside the row (no shuffle)."""
    docs = read_table(spark, sf_dir, "documents").select(
        "doc_id", F.split("text", "\n", -1).alias("lines"))
    lines = F.col("lines")   # a column reference, so the lambda does not re-split per element
    pairs = F.when(F.size(lines) > 1, F.transform(
        F.sequence(F.lit(0), F.size(lines) - 2),
        lambda i: F.struct(i.alias("pos"), F.element_at(lines, i + 1).alias("en"),
                           F.element_at(lines, i + 2).alias("zh")))
    ).otherwise(F.array().cast("array<struct<pos:int,en:string,zh:string>>"))
    return docs.select("doc_id", F.explode(pairs).alias("p")).select(
        (F.col("doc_id") * LINE_PAIR_STRIDE + F.col("p.pos")).alias("pair_id"),
        F.col("p.en").alias("en"), F.col("p.zh").alias("zh"))


def raw_news(spark, sf_dir) -> DataFrame:
    return bitext(spark, sf_dir).select("pair_id", F.concat_ws("\t", "en", "zh").alias("value"))


def raw_titles(spark, sf_dir) -> DataFrame:
    return line_pairs(spark, sf_dir).select("pair_id", F.concat_ws("\t", "zh", "en").alias("value"))


def mined_score(pair_id):
    """Margin score text ``1.00``-``1.19`` from the conversation id (``pair_id div 100``)."""
    conv = F.floor(pair_id / 100).cast("bigint")
    return F.concat(F.lit("1."), F.lpad(F.pmod(conv, F.lit(20)).cast("string"), 2, "0"))


def mined_tag(pair_id):
    conv = F.floor(pair_id / 100).cast("bigint")
    return F.when(F.pmod(conv, F.lit(2)) == 0, "zh-Hans").otherwise("zh-Hant")


def raw_mined(spark, sf_dir) -> DataFrame:
    m = mined_pairs(spark, sf_dir)
    return m.select("pair_id", F.concat_ws("\t", mined_score(F.col("pair_id")), "en", "zh",
                                           F.lit("en"), mined_tag(F.col("pair_id"))).alias("value"))


def raw_bad(spark, sf_dir) -> DataFrame:
    extra = spark.createDataFrame(BAD_LINES, "pair_id bigint, value string")
    return raw_news(spark, sf_dir).unionByName(extra)


def logits(spark, sf_dir) -> DataFrame:
    emb = read_table(spark, sf_dir, "embeddings")
    return emb.select("vec_id", F.col("embedding").cast("array<double>").alias("scores"), "label",
                      F.floor(F.col("vec_id") / BATCH_LOGITS).alias("batch_id"))


def log_own(spark, sf_dir) -> DataFrame:
    """Own-loop log lines: ``seq, value`` (seq = event_id, the line order)."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "event_type", "value", "props")
    line = F.when(F.col("event_type") == "error", F.concat(F.lit("warning: "), F.col("props"))) \
        .otherwise(F.concat(F.lit("batch loss at "), F.col("event_id").cast("string"), F.lit(" = "),
                            F.format_string("%.4f", F.col("value"))))
    return ev.select(F.col("event_id").alias("seq"), line.alias("value"))


def log_trainer(spark, sf_dir) -> DataFrame:
    """Trainer log lines (one dict per line): ``seq, value``."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    v = F.format_string("%.4f", F.col("value"))
    line = (F.when(F.col("event_type") == "signup", F.concat(F.lit("{'eval_loss': "), v, F.lit("}")))
            .when(F.col("event_type") == "error",
                  F.concat(F.lit("Saving model checkpoint to out/checkpoint-"),
                           F.col("event_id").cast("string")))
            .otherwise(F.concat(F.lit("{'loss': "), v,
                                F.lit(", 'learning_rate': 2e-05, 'epoch': 0.1}"))))
    return ev.select(F.col("event_id").alias("seq"), line.alias("value"))


def labels_long(spark, sf_dir) -> DataFrame:
    """``model, split, metric, value``: label averages per source and language."""
    lab = read_table(spark, sf_dir, "labels")
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "lang")
    j = lab.join(docs, "doc_id")
    long = j.select(F.col("source").alias("model"), F.col("lang").alias("split"),
                    F.explode(F.array(
                        F.struct(F.lit("quality").alias("metric"), F.col("quality").alias("v")),
                        F.struct(F.lit("toxic").alias("metric"), F.col("toxic").alias("v")))
                    ).alias("m"))
    return long.groupBy("model", "split", F.col("m.metric").alias("metric")).agg(
        F.avg(F.col("m.v").cast("double")).alias("value"))


# ---------------------------------------------------------------------------------------------
# The same inputs as DuckDB CTEs
# ---------------------------------------------------------------------------------------------

WS_SQL = "||".join(f"chr({ord(c)})" for c in PY_WHITESPACE)


def sql_strip(x: str) -> str:
    return f"trim({x}, {WS_SQL})"


_SQL = {
    "bitext": """SELECT u.conv_id * 100 + u.turn AS pair_id, replace(u.text, chr(10), ' ') AS en,
            replace(a.text, chr(10), ' ') AS zh
        FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
        WHERE u.role = 'user' AND a.role = 'assistant'""",
    "mined_pairs": """SELECT a.conv_id * 100 + a.turn AS pair_id, replace(a.text, chr(10), ' ') AS en,
            replace(u.text, chr(10), ' ') AS zh
        FROM conversations a JOIN conversations u ON u.conv_id = a.conv_id AND u.turn = a.turn + 1
        WHERE a.role = 'assistant' AND u.role = 'user'""",
    "doc_lines": """SELECT doc_id, CAST(i - 1 AS INTEGER) AS pos, l[i] AS line
        FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents) d,
             LATERAL (SELECT unnest(range(1, len(d.l) + 1)) AS i) r""",
    "line_pairs": f"""SELECT * FROM (SELECT doc_id * {LINE_PAIR_STRIDE} + pos AS pair_id, line AS en,
            lead(line) OVER (PARTITION BY doc_id ORDER BY pos) AS zh FROM doc_lines) t
        WHERE zh IS NOT NULL""",
    "raw_news": "SELECT pair_id, en || chr(9) || zh AS value FROM bitext",
    "raw_titles": "SELECT pair_id, zh || chr(9) || en AS value FROM line_pairs",
    "raw_mined": """SELECT pair_id, '1.' || lpad(CAST((pair_id // 100) % 20 AS VARCHAR), 2, '0') || chr(9) || en
            || chr(9) || zh || chr(9) || 'en' || chr(9)
            || CASE WHEN (pair_id // 100) % 2 = 0 THEN 'zh-Hans' ELSE 'zh-Hant' END AS value
        FROM mined_pairs""",
    "raw_bad": """SELECT pair_id, value FROM raw_news UNION ALL
        SELECT * FROM (VALUES (-1, 'only one field'), (-2, 'a' || chr(9) || 'b' || chr(9) || 'c'),
            (-3, 'left side' || chr(9) || '   '), (-4, chr(12288) || chr(9) || 'right side')) v(pair_id, value)""",
    "logits": f"""SELECT vec_id, CAST(embedding AS DOUBLE[]) AS scores, label, CAST(floor(vec_id / {BATCH_LOGITS}) AS BIGINT) AS batch_id
        FROM embeddings""",
    "log_own": """SELECT event_id AS seq, CASE WHEN event_type = 'error' THEN 'warning: ' || props
            ELSE 'batch loss at ' || CAST(event_id AS VARCHAR) || ' = ' || printf('%.4f', value) END AS value
        FROM events""",
    "log_trainer": """SELECT event_id AS seq, CASE
            WHEN event_type = 'signup' THEN '{''eval_loss'': ' || printf('%.4f', value) || '}'
            WHEN event_type = 'error' THEN 'Saving model checkpoint to out/checkpoint-' || CAST(event_id AS VARCHAR)
            ELSE '{''loss'': ' || printf('%.4f', value) || ', ''learning_rate'': 2e-05, ''epoch'': 0.1}' END AS value
        FROM events""",
    "labels_long": """SELECT model, split, metric, avg(v) AS value FROM (
            SELECT d.source AS model, d.lang AS split, 'quality' AS metric, CAST(l.quality AS DOUBLE) AS v
            FROM labels l JOIN documents d USING (doc_id)
            UNION ALL
            SELECT d.source, d.lang, 'toxic', CAST(l.toxic AS DOUBLE) FROM labels l JOIN documents d USING (doc_id))
        GROUP BY ALL""",
}

_DEPS = {
    "line_pairs": ["doc_lines"], "raw_news": ["bitext"], "raw_titles": ["line_pairs"],
    "raw_mined": ["mined_pairs"], "raw_bad": ["raw_news"],
}

BUILDERS = {
    "bitext": bitext, "mined_pairs": mined_pairs, "doc_lines": doc_lines, "line_pairs": line_pairs,
    "raw_news": raw_news, "raw_titles": raw_titles, "raw_mined": raw_mined, "raw_bad": raw_bad,
    "logits": logits, "log_own": log_own, "log_trainer": log_trainer, "labels_long": labels_long,
}


def _order(names) -> list[str]:
    seen: list[str] = []

    def visit(n):
        for d in _DEPS.get(n, []):
            visit(d)
        if n not in seen:
            seen.append(n)

    for n in names:
        visit(n)
    return seen


def with_inputs(*names: str, extra: list[tuple[str, str]] = ()) -> str:
    """``WITH`` clause defining the named inputs (and what they need), then ``extra`` CTEs."""
    parts = [f"{n} AS ({_SQL[n]})" for n in _order(names)]
    parts += [f"{n} AS ({body})" for n, body in extra]
    return "WITH " + ",\n".join(parts) + "\n" if parts else ""
