"""N-gram language model as aggregations (E1-E4), the Spark-scale stand-in for fine-tuning a network.

* E1 counts (order, context, token) per model; map-side partial aggregation absorbs hot contexts.
* E2 scores held-out text with interpolated probabilities through three left joins.
* E3 turns one context's candidates into a sampling distribution with array functions
  (repetition penalty -> temperature -> top-k -> softmax -> top-p -> renormalise).
* E4 draws one token with a seeded md5 uniform, so every run and every engine agrees.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import bound
from ..session import broadcast_if_few, stored
from .training import BOS, EOS, tokens

# Interpolation weights for orders 3, 2, 1.
LAMBDAS = (0.6, 0.3, 0.1)


def padded_tokens(sentence) -> Column:
    """Two start marks, the tokens, one end mark."""
    return F.concat(F.array(F.lit(BOS), F.lit(BOS)), tokens(sentence), F.array(F.lit(EOS)))


def events(df: DataFrame, col: str = "sentence", group_cols=("model",)) -> DataFrame:
    """One row per predicted position: ``(model, ctx3, ctx2, token)``."""
    g = list(group_cols)
    p = df.select(*g, padded_tokens(col).alias("_p")).select(*g, "_p", (F.size("_p") - 2).alias("_n"))
    zipped = F.arrays_zip(
        F.slice("_p", 1, F.col("_n")).alias("a"), F.slice("_p", 2, F.col("_n")).alias("b"), F.slice("_p", 3, F.col("_n")).alias("token")
    )
    ev = p.select(*g, F.inline(zipped))
    return ev.select(*g, F.concat_ws(" ", "a", "b").alias("ctx3"), F.col("b").alias("ctx2"), "token")


def fit_ngrams(df: DataFrame, col: str = "sentence", group_cols=("model",)) -> DataFrame:
    """``(model, order, ctx, token, cnt, ctx_cnt)`` for orders 1..3.

    Only the longest contexts are counted from the text, and stored: a context of order 2 is the last word of those of
    order 3, so lower orders are sums of these counts.  A context's total is a window over its counted continuations,
    however often they occur; a group's total of order 1, a row per group, is broadcast after a count.
    """
    g = list(group_cols)
    ev = events(df, col, g)
    for c in g:
        ev = ev.where(F.col(c).isNotNull())
    c3 = stored(ev.groupBy(*g, F.col("ctx3").alias("ctx"), "token").agg(F.count(F.lit(1)).alias("cnt")), "trigrams")
    c2 = c3.groupBy(*g, F.substring_index("ctx", " ", -1).alias("ctx"), "token").agg(F.sum("cnt").alias("cnt"))
    c2 = stored(c2, "bigrams")
    c1 = stored(c2.groupBy(*g, "token").agg(F.sum("cnt").alias("cnt")), "unigrams")
    total = F.sum("cnt").over(Window.partitionBy(*g, "order", "ctx"))
    out = ["order", "ctx", "token", "cnt", "ctx_cnt"]
    longer = c3.withColumn("order", F.lit(3)).unionByName(c2.withColumn("order", F.lit(2))).withColumn("ctx_cnt", total)
    totals = broadcast_if_few(c1.groupBy(*g).agg(F.sum("cnt").alias("ctx_cnt")))
    single = c1.join(totals, g).withColumns({"order": F.lit(1), "ctx": F.lit("")})
    return longer.select(*g, *out).unionByName(single.select(*g, *out))


def perplexity(model: DataFrame, heldout: DataFrame, col: str = "sentence", group_cols=("model",)) -> DataFrame:
    """``exp(-mean(ln p))`` over held-out positions, ``p = .6 p3 + .3 p2 + .1 p1``.

    ``p1 = (cnt + 1) / (N + V + 1)`` over V known tokens plus one unknown, so it is never zero.  Equal events are
    counted before they are joined, and no join is on the group alone: its one-row normaliser is broadcast after a
    count.  The model is stored once; the three orders and the normaliser read it.
    """
    g = list(group_cols)
    model = stored(model.select(*g, "order", "ctx", "token", "cnt", "ctx_cnt"), "ngrams")
    ev = events(heldout, col, g).groupBy(*g, "ctx3", "ctx2", "token").agg(F.count(F.lit(1)).alias("_n"))
    m3 = model.filter("order = 3").select(*g, F.col("ctx").alias("ctx3"), "token", (F.col("cnt") / F.col("ctx_cnt")).alias("p3"))
    m2 = model.filter("order = 2").select(*g, F.col("ctx").alias("ctx2"), "token", (F.col("cnt") / F.col("ctx_cnt")).alias("p2"))
    m1 = model.filter("order = 1").select(*g, "token", "cnt")
    norm = m1.groupBy(*g).agg((F.sum("cnt") + F.count(F.lit(1)) + 1).alias("_den"))
    j = (
        ev.join(m3, [*g, "ctx3", "token"], "left")
        .join(m2, [*g, "ctx2", "token"], "left")
        .join(m1, [*g, "token"], "left")
        .join(broadcast_if_few(norm), g, "left")
    )
    p1 = (F.coalesce("cnt", F.lit(0)) + 1) / F.col("_den")
    p = LAMBDAS[0] * F.coalesce("p3", F.lit(0.0)) + LAMBDAS[1] * F.coalesce("p2", F.lit(0.0)) + LAMBDAS[2] * p1
    return j.groupBy(*g).agg(
        F.sum("_n").alias("n_events"),
        F.round(F.exp(-F.sum(F.ln(p) * F.col("_n")) / F.sum("_n")), 6).alias("perplexity"),
    )


def candidates(model: DataFrame, cap: int | None, group_cols=("model",)) -> DataFrame:
    """Per (model, order, ctx): ``ctx_cnt`` and the ``cap`` most frequent continuations as
    ``ARRAY<STRUCT<token, cnt>>`` ordered by (cnt desc, token asc); ``cap=None`` keeps every continuation.

    With a penalty of 1 or more a penalised token can only move down, so ``k`` plus the number of distinct penalised
    tokens is an exact cap.  Below 1 a penalised token moves up from anywhere: use ``cap=None``.
    """
    g = list(group_cols)
    if cap is not None:
        w = Window.partitionBy(*g, "order", "ctx").orderBy(F.col("cnt").desc(), F.col("token"))
        model = model.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= cap)
    return model.groupBy(*g, "order", "ctx").agg(
        F.first("ctx_cnt").alias("ctx_cnt"),
        F.transform(
            F.array_sort(F.collect_list(F.struct((-F.col("cnt")).alias("k"), F.col("token"), F.col("cnt")))),
            lambda x: F.struct(x["token"].alias("token"), x["cnt"].alias("cnt")),
        ).alias("cands"),
    )


def next_token_dist(cands: Column, ctx_cnt: Column, history: Column, temperature, top_k, top_p,
                    penalty) -> Column:
    """E3 on one candidate array -> ``ARRAY<STRUCT<token, rank, pr>>`` (kept tokens, renormalised).

    Rules: ``sc = ln(cnt/ctx_cnt)``, times ``penalty`` when the token is in ``history``, divided by
    the temperature; rank by ``round(sc, 9)`` desc then token; keep rank <= k; softmax; keep rows whose
    preceding cumulative probability, rounded to 9 places, is below ``top_p``; renormalise.

    The sorted top-k array and its powers are bound once per row (a column referenced inside a lambda would be
    re-evaluated for every element); a fold picks the kept ones.
    """
    T_, K_, P_, R_ = (F.lit(x) if not isinstance(x, Column) else x for x in (temperature, top_k, top_p, penalty))
    # Most contexts have one continuation, which is certain whatever its score.
    alone = (F.size(cands) == 1) & (T_ > 0) & (K_ >= 1) & (P_ > 0)
    certain = F.transform(cands, lambda x: F.struct(x["token"].alias("token"), F.lit(1).alias("rank"), F.lit(1.0).alias("pr")))

    # Penalised candidates = tokens both in the array and in the history (hash-based intersection, once
    # per row); zip_with hands the same small set to every element without re-evaluating it.
    pen = F.array_intersect(F.transform(cands, lambda x: x["token"]), history)
    scored0 = F.zip_with(
        cands, F.array_repeat(pen, F.size(cands)),
        lambda x, p: F.struct(
            x["token"].alias("token"),
            (F.ln(x["cnt"] / ctx_cnt) * F.when(F.array_contains(p, x["token"]), R_).otherwise(F.lit(1.0)) / T_).alias("sc"),
        ),
    )
    # Natural struct order (-round(sc, 9), token) is exactly the ranking rule, and sorts without a lambda.
    scored = F.transform(scored0, lambda x: F.struct((-F.round(x["sc"], 9)).alias("k"), x["token"].alias("token"), x["sc"].alias("sc")))
    top = F.slice(F.sort_array(scored), 1, K_)
    start = F.struct(
        F.lit(0.0).alias("s"), F.lit(0.0).alias("zk"), F.lit(0).alias("i"),
        F.array().cast("array<struct<token:string,rank:int,pr:double>>").alias("out"),
    )

    def keep(b, x):
        # Rounding decides only close to the limit; it is by far the dearest part of a step.
        kept = F.when(F.abs(b["s"] - P_) > 1e-8, b["s"] < P_).otherwise(F.round(b["s"], 9) < P_)
        item = F.struct(x["token"].alias("token"), (b["i"] + 1).alias("rank"), x["pr"].alias("pr"))
        return F.struct(
            (b["s"] + x["pr"]).alias("s"),
            F.when(kept, b["zk"] + x["pr"]).otherwise(b["zk"]).alias("zk"),
            (b["i"] + 1).alias("i"),
            F.when(kept, F.concat(b["out"], F.array(item))).otherwise(b["out"]).alias("out"),
        )

    def renormalised(b):
        return F.transform(b["out"], lambda y: F.struct(y["token"].alias("token"), y["rank"].alias("rank"), (y["pr"] / b["zk"]).alias("pr")))

    def weigh(xs):
        """Powers relative to the first, highest score."""
        return F.transform(xs, lambda x: F.struct(x["token"].alias("token"), F.exp(x["sc"] - F.get(xs, F.lit(0))["sc"]).alias("pr")))

    def share(xs):
        z = F.aggregate(xs, F.lit(0.0), lambda a, x: a + x["pr"])
        return bound(F.struct(xs.alias("xs"), z.alias("z")), lambda w: F.transform(
            w["xs"], lambda x: F.struct(x["token"].alias("token"), (x["pr"] / w["z"]).alias("pr"))))

    dist = F.aggregate(bound(bound(top, weigh), share), start, keep, renormalised)
    return F.when(alone, certain).otherwise(dist)


def uniform(*parts) -> Column:
    """Seeded uniform in [0, 1) from the first 32 bits of md5 over ``'|'``-joined parts."""
    key = F.concat_ws("|", *[p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts])
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def draw_int(*parts) -> Column:
    """The same 32-bit draw as an integer (for choosing positions)."""
    key = F.concat_ws("|", *[p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts])
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint")


def sample_token(dist: Column, u: Column) -> Column:
    """First token whose inclusive cumulative probability exceeds ``u``; the last one if none."""
    init = F.struct(F.lit(0.0).alias("s"), F.lit(None).cast("string").alias("t"), F.lit(None).cast("string").alias("last"))
    return F.aggregate(
        dist, init,
        lambda acc, x: F.struct(
            (acc["s"] + x["pr"]).alias("s"),
            F.when(acc["t"].isNull() & ((acc["s"] + x["pr"]) > u), x["token"]).otherwise(acc["t"]).alias("t"),
            x["token"].alias("last"),
        ),
        lambda acc: F.coalesce(acc["t"], acc["last"]),
    )
