"""Every merge against a plain recount, and the two ways of merging against each other."""

import random
from collections import Counter

from cadenza.operators.bpe import learn_bpe, word_table


def brute(words):
    """words: {word: freq}; counts all pairs anew for each merge."""
    table = {w: [*w[:-1], w[-1] + "</w>"] for w in words}
    out = []
    while True:
        counts = Counter()
        for w, s in table.items():
            for pair in zip(s, s[1:]):
                counts[pair] += words[w]
        if not counts or max(counts.values()) < 2:
            return out
        left, right = min(counts, key=lambda p: (-counts[p], p))
        out.append((left, right, counts[left, right]))
        for w, s in table.items():
            new = []
            for x in s:
                if new and new[-1] == left and x == right:
                    new[-1] = left + right
                else:
                    new.append(x)
            table[w] = new


def corpus(spark):
    rng = random.Random(2)
    rows = []
    for model in ("a", "b", "c"):
        words = ["".join(rng.choice("aabbcde'") for _ in range(rng.randrange(1, 9))) for _ in range(40)] + ["aaaa", "aaa", "a", "."]
        rows += [(model, " ".join(rng.choices(words, k=12)) + " aaaa aaa.") for _ in range(25)]
    rows.append(("lone", "x"))
    return spark.createDataFrame(rows, "model string, sentence string")


def by_model(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.model, {})[r.rank] = (r.left, r.right, r.n)
    return {m: [v[k] for k in sorted(v)] for m, v in out.items()}


def test_every_merge_against_a_recount(spark):
    table = word_table(corpus(spark))
    words = {}
    for r in table.collect():
        words.setdefault(r.model, {})[r.word] = r.freq
    want = {m: merges for m, w in words.items() if (merges := brute(w))}
    assert min(len(want[m]) for m in "abc") > 50 and "lone" not in want
    assert by_model(learn_bpe(table)) == want


def test_rounds_over_all_tasks_give_the_same(spark):
    table = word_table(corpus(spark))
    assert by_model(learn_bpe(table, 6, task_words=0)) == by_model(learn_bpe(table, 6))
    # Models on either side of the bound.
    sizes = sorted(r["count"] for r in table.groupBy("model").count().collect())
    assert by_model(learn_bpe(table, 4, task_words=sizes[1])) == by_model(learn_bpe(table, 4))


def test_rounds_keep_rows_and_no_plans(spark):
    """The driver's plan of the result does not grow with the merges."""
    table = word_table(corpus(spark))
    few, many = (learn_bpe(table, k, task_words=0) for k in (2, 12))
    assert by_model(many) == by_model(learn_bpe(table, 12))
    assert len(many._jdf.queryExecution().optimizedPlan().toString().splitlines()) == len(few._jdf.queryExecution().optimizedPlan().toString().splitlines())


def test_a_task_merges_many_words_in_little_memory():
    import tracemalloc

    import numpy as np

    from cadenza.operators.bpe import merges_of

    rng = np.random.default_rng(1)
    n = 60_000
    lengths = rng.integers(1, 12, n)
    symbols = rng.integers(0, 26, int(lengths.sum())).astype(np.int32)
    freqs = rng.integers(1, 50, n)
    tracemalloc.start()
    found = list(merges_of([chr(97 + k) for k in range(26)], symbols, lengths, freqs, 20))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found) == 20 and found[0][2] >= found[-1][2] and peak < 600 * n
