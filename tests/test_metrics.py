"""BLEU, loss and greedy-pick goldens (FIXTURES section 3)."""

import math

from pyspark.sql import functions as F

from tandem.functions import arrays as A
from tandem.functions import text as TX
from tandem.operators import metrics as M
from tests.conftest import SF01


def _bleu(spark, pairs):
    df = spark.createDataFrame([(i, h.split(), r.split()) for i, (h, r) in enumerate(pairs)],
                               "pair_id long, h array<string>, r array<string>")
    return M.corpus_bleu(M.bleu_stats(df, "h", "r")).first()


def test_bleu_hand_goldens(spark):
    assert round(_bleu(spark, [("a b c d e", "a b c x e")])["bleu"], 4) == 42.7287
    assert abs(_bleu(spark, [("a b c d e f", "a b c d e f")])["bleu"] - 100.0) < 1e-9
    assert _bleu(spark, [("a b", "c d")])["bleu"] == 0.0
    assert round(M.bleu_formula_py([4, 2, 1, 0], [5, 4, 3, 2], 5, 5), 4) == 42.7287


def test_bleu_stats_on_bitext(spark):
    from tandem.plans import inputs as I
    b = I.bitext(spark, SF01)
    toks = b.select("pair_id", TX.pretok_words(F.lower("en")).alias("h"),
                    TX.pretok_words(F.lower("zh")).alias("r"))
    st = {r["n"]: (r["matches"], r["total"]) for r in M.bleu_stats(toks, "h", "r").collect()}
    assert [st[n][0] for n in (1, 2, 3, 4)] == [3116, 222, 21, 9]
    assert [st[n][1] for n in (1, 2, 3, 4)] == [8728, 8495, 8262, 8029]


def test_brevity_penalty_and_smoothing(spark):
    r = _bleu(spark, [("a b c", "a b c d e f")])
    m, t = [3, 2, 1, 0], [3, 2, 1, 0]
    assert math.isclose(r["bp"], math.exp(1 - 6 / 3))
    assert math.isclose(r["bleu"], M.bleu_formula_py(m, t, 3, 6), abs_tol=1e-9)


def test_eval_loss_golden(spark):
    from tandem.plans import inputs as I
    e = M.eval_loss(M.masked_loss(I.logits(spark, SF01))).first()
    assert math.isclose(e["loss_batch_mean"], 4.164378109998394, rel_tol=1e-9)


def test_argmax_ties_lowest(spark):
    df = spark.createDataFrame([([0.1, 0.9, 0.9],)], "s array<double>")
    assert df.select(A.argmax("s")).first()[0] == 1


def test_log_softmax_sums_to_one(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0],)], "s array<double>")
    p = df.select(A.softmax("s")).first()[0]
    assert math.isclose(sum(p), 1.0)


def test_evaluate_from_ids(spark):
    vocab = spark.createDataFrame([(t, i) for i, t in enumerate(
        ["<unk>", "<pad>", "<bos>", "<eos>", "a", "b", "c", "d"])], "token string, id int")
    df = spark.createDataFrame([(1, [2, 4, 5, 6, 7, 3, 7], [2, 4, 5, 6, 7, 3, 1])],
                               "pair_id long, p array<int>, r array<int>")
    split_tok = lambda c: F.split(c, " ")
    cut = {r["metric"]: r["value"] for r in M.evaluate_ids(df, "p", "r", vocab, split_tok,
                                                           cut_eos=True).collect()}
    assert abs(cut["bleu"] - 100.0) < 1e-9
    raw = {r["metric"]: r["value"] for r in M.evaluate_ids(df, "p", "r", vocab, split_tok).collect()}
    assert raw["hyp_len"] == 5.0 and raw["bleu"] < 100.0


def test_clipped_counts_equal_counters(spark):
    """Random rows, repeated tokens, empty and null sides, tokens with blanks; whole table and by group."""
    import random
    from collections import Counter
    rnd = random.Random(5)
    rows = []
    for i in range(300):
        side = [[rnd.choice(["a", "b", "c c", "", "dd"]) for _ in range(rnd.randint(0, 9))] for _ in range(2)]
        rows.append((i, rnd.choice("xy"), *side))
    rows += [(300, "x", None, ["a"]), (301, "y", ["a"], None), (302, "x", [], []), (303, "y", ["a"] * 5000, ["a"] * 4000)]
    want = Counter()
    for _, g, h, r in rows:
        if h is None or r is None:
            continue
        for n in range(1, 5):
            hs, rs = (Counter(tuple(s[i:i + n]) for i in range(len(s) - n + 1)) for s in (h, r))
            want[g, n] += 0
            want[g, n, "m"] += sum((hs & rs).values())
            want[g, n, "t"] += sum(hs.values())
            want[g, n, "r"] += sum(rs.values())
    df = spark.createDataFrame(rows, "pair_id long, g string, h array<string>, r array<string>").repartition(3)
    by = M.bleu_stats(df, "h", "r", by=["g"])
    got = {(r["g"], r["n"]): (r["matches"], r["total"], r["ref_total"]) for r in by.collect()}
    assert got == {(g, n): tuple(want[g, n, s] for s in "mtr") for g in "xy" for n in range(1, 5)}
    whole = M.bleu_stats(df, "h", "r")
    assert {r["n"]: r["matches"] for r in whole.collect()} == {n: want["x", n, "m"] + want["y", n, "m"] for n in range(1, 5)}
    plan = whole._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Aggregate" not in plan.split("MapInArrow")[1]


def test_bleu_stats_of_no_rows(spark):
    df = spark.createDataFrame([], "pair_id long, h array<string>, r array<string>")
    assert M.bleu_stats(df, "h", "r").count() == 0


def test_evaluate_reports_the_loss_per_split(spark):
    rows = [(1, "val", "a b c d", "a b c d"), (2, "test", "a b", "a c")]
    pred = spark.createDataFrame(rows, "pair_id long, split string, pred string, ref string")
    losses = spark.createDataFrame([("val", 1.0, 1), ("val", 3.0, 3), ("test", 5.0, 2)], "split string, loss double, n_rows long")
    args = dict(by=["split"], tokenize=TX.pretok_words)
    split = {(r["split"], r["metric"]): r["value"] for r in M.evaluate(
        pred.drop("ref"), pred.select("pair_id", "ref"), losses=losses, **args).collect()}
    assert split["val", "loss"] == 2.0 and split["test", "loss"] == 5.0 and split["val", "bleu"] > 0.99
    rowed = M.evaluate(pred.drop("ref"), pred.select("pair_id", "ref"), losses=losses, weighting="row", **args)
    assert {r["split"]: r["value"] for r in rowed.where("metric = 'loss'").collect()} == {"val": 2.5, "test": 5.0}
    whole = M.evaluate(pred.drop("ref"), pred.select("pair_id", "ref"), losses=losses.drop("split"), **args)
    assert [(r["split"], r["value"]) for r in whole.where("metric = 'loss'").collect()] == [("all", 3.0)]


def test_counts_are_taken_on_slices_of_bounded_tokens():
    import pyarrow as pa
    from tandem.operators import metrics as ME
    hyp = pa.array([["a"] * n if n is not None else None for n in (3, 0, None, 9, 1, 1, 1)], pa.list_(pa.string()))
    ref = pa.array([["a"], ["b"], ["a"], None, [], ["a"] * 2, ["a"]], pa.list_(pa.string()))
    slices = list(ME.token_slices(hyp, ref, 4))
    assert slices == [(0, 1), (1, 2), (3, 1), (4, 2), (6, 1)]
    whole = ME.clipped_counts(hyp, ref)
    parts = [ME.clipped_counts(hyp.slice(i, n), ref.slice(i, n)) for i, n in slices]
    assert [x.tolist() for x in whole] == [[v for p in parts for v in p[k].tolist()] for k in range(len(whole))]
