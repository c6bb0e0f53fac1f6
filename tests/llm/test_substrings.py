import random
from collections import defaultdict

from cadenza.llm.substrings import substring_dedup, units_of

from .edge import LONG, ROWS, docs_of, edge, none


def cut_by_hand(text):
    """Units by walking the characters: an own rule, not the operator's pattern."""
    out, at, k = [], 0, 0
    while k < len(text):
        if text[k] == "\n":
            while k < len(text) and text[k] == "\n":
                k += 1
        elif text[k] in " \t" and k and text[k - 1] in ".!?…":
            while k < len(text) and text[k] in " \t":
                k += 1
        elif k and text[k - 1] in "。！？" and k > at:
            pass
        else:
            k += 1
            continue
        out.append((at, k))
        at = k
        if k < len(text) and text[k - 1] in "。！？":
            k += 1
    out.append((at, len(text)))
    return [(s, e, text[s:e].lower().split()) for s, e in out if text[s:e].split()]


def brute(rows, min_words=20):
    """rows: (id, text) with distinct ids; every run is searched for as consecutive units of its first document."""
    units = {d: cut_by_hand(t) for d, t in rows}
    firsts = {}
    for d in sorted(units):
        for k, (_, _, words) in enumerate(units[d]):
            if len(words) >= min_words:
                firsts.setdefault((tuple(words),), (d, k))
            if k + 1 < len(units[d]):
                firsts.setdefault((tuple(words), tuple(units[d][k + 1][2])), (d, k))
    out = {}
    for d, text in rows:
        mine, gone, from_, place = units[d], set(), set(), {}
        for k, (_, _, words) in enumerate(mine):
            own = {}
            for size in (1, 2):
                key = tuple(tuple(u[2]) for u in mine[k : k + size])
                if len(key) < size or (size == 1 and len(words) < min_words):
                    continue
                where = firsts[key]
                if where[0] == d:
                    where = next((d, j) for j in range(k + 1) if tuple(tuple(u[2]) for u in mine[j : j + size]) == key)
                    if k - where[1] < size:
                        continue
                own[size] = where
            if 1 in own:
                gone.add(k)
                from_.add(own[1][0])
            place[k] = own.get(2)
        k = 0
        while k < len(mine):
            if place[k]:
                j = k
                while j + 1 < len(mine) and place[j + 1] == (place[j][0], place[j][1] + 1):
                    j += 1
                if sum(len(mine[i][2]) for i in range(k, j + 2)) >= min_words:
                    gone |= set(range(k, j + 2))
                    from_.add(place[k][0])
                k = j + 1
            else:
                k += 1
        spans = []
        for k in sorted(gone):
            s, e, _ = mine[k]
            if spans and spans[-1][1] >= s:
                spans[-1][1] = e
            else:
                spans.append([s, e])
        kept, at = "", 0
        for s, e in spans:
            kept, at = kept + text[at:s], e
        out[d] = (kept + text[at:], ",".join(f"{s}:{e}" for s, e in spans), sorted(from_))
    return out


def rows_of(df):
    return {r.doc_id: (r.text, r.removed, r.first_ids) for r in df.collect()}


def test_units_cover_words_in_order():
    text = "One two. Three four\n\nfive Six SEVEN!! eight. nine É x 漢字。かな。"
    assert [(s, e) for s, e, _ in units_of(text)] == [(s, e) for s, e, _ in cut_by_hand(text)]
    assert "".join(text[s:e] for s, e, _ in units_of(text)) == text


def test_sample_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    want = brute([(r.doc_id, r.text or "") for r in docs.collect()])
    assert rows_of(substring_dedup(docs)) == want
    assert any(x[1] for x in want.values())


def sentence(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(n)).capitalize() + "."


def test_shared_passages_are_caught_and_clean_texts_stay(spark):
    rng = random.Random(5)
    passage = " ".join(sentence(rng, 9) for _ in range(7))
    clean = [" ".join(sentence(rng, 12) for _ in range(6)) for _ in range(20)]
    holders = [f"{sentence(rng, 10)} {sentence(rng, 4)} {passage} {sentence(rng, 5).lower()} {sentence(rng, 11)}" for _ in range(10)]
    rows = rows_of(substring_dedup(docs_of(spark, [*clean, *holders])))
    assert all(rows[k] == (clean[k], "", []) for k in range(20))
    assert rows[20][1] == ""
    for k in range(21, 30):
        text = holders[k - 20]
        start, end = map(int, rows[k][1].split(":"))
        assert text[start:end].strip() == passage and rows[k][2] == [20] and rows[k][0] == text[:start] + text[end:]


def test_units_of_several_documents_are_no_run(spark):
    rng = random.Random(8)
    parts = [sentence(rng, 9) for _ in range(4)]
    texts = [f"{sentence(rng, 6)} {p} {sentence(rng, 6)}" for p in parts] + [" ".join(parts)]
    assert rows_of(substring_dedup(docs_of(spark, texts)))[4] == (texts[4], "", [])


def test_hot_passage_against_brute_force(spark):
    rng = random.Random(6)
    lines = [" ".join(f"w{rng.randrange(50)}" for _ in range(rng.randrange(1, 30))) for _ in range(40)]
    texts = ["\n".join(rng.choice(lines) for _ in range(rng.randrange(8))) for _ in range(300)]
    assert rows_of(substring_dedup(docs_of(spark, texts))) == brute(list(enumerate(texts)))


def test_edge_rows_and_empty_table(spark):
    got = defaultdict(list)
    for r in substring_dedup(edge(spark), min_words=5).collect():
        got[r.doc_id].append((r.text, r.n_removed_words, r.first_ids))
    assert sum(map(len, got.values())) == len(ROWS)
    assert got[1] == [(ROWS[0][1], 0, [])] and got[3] == [("", 0, [])]
    assert got[2] == [(ROWS[1][1], 0, [])] * 2  # other line breaks, so other units
    assert sorted(got[None]) == [("", 0, []), ("", 9, [1])]
    assert got[4][0][0] == LONG[: len("The quick onthe brown of and the fox. ")]
    assert substring_dedup(none(spark)).count() == 0
