"""Decontamination against a word-by-word version."""

from __future__ import annotations

import random
import re
from functools import lru_cache

from martlet.llm import decontam
from martlet.llm.catalog import QUERIES
from martlet.llm.common import table

SF = "/root/testdata/sf0.001"
ITEM = (1, "A train leaves Paris at 9 with 120 people and travels 300 km to reach Lyon before it turns back to Paris at 12.")
OTHER = (2, "the quick brown fox jumps over the lazy dog while seven small birds sing old songs near the river bank")
SHORT = (3, "four little words only")


@lru_cache(maxsize=None)
def templates(text):
    words, out = [], []
    for m in re.finditer(r"(?:\d+(?:[.,]\d+)*)|[^\W\d_]+(?:[^\W_]*)", text):
        before = text[max(0, m.start() - 2) : m.start()]
        name = m[0][0].isupper() and bool(re.fullmatch(r"[a-zà-ÿ\d,;]\s", before))
        words.append(m[0])
        if m[0][0].isdigit():
            out.append("#num")
        elif name:
            out.append("#name")
        elif out and out[-1] == "#num" and m[0].lower() in decontam.UNITS:
            out.append("#unit")
        else:
            out.append(m[0].lower())
    return out, [w.lower() for w in words]


def brute(docs, items, window=5, similarity=0.8, min_run=13, min_words=decontam.MIN_WORDS):
    def windows(text):
        t, w = templates(text or "")
        size = min(window, len(t))
        for a in range(len(t) - size + 1 if t else 0):
            yield a, size, t[a : a + size], w[a : a + size]

    def key(size, t, w):
        return tuple(t if sum(x[0] != "#" for x in t) >= min(min_words, size) else w)

    @lru_cache(maxsize=None)
    def places(body, size):
        t, w = templates(body or "")
        by = {}
        for b in range(len(t) - size + 1):
            by.setdefault(key(size, t[b : b + size], w[b : b + size]), []).append(b)
        return by

    found = set()
    for item, text in items:
        mine = list(windows(text))
        if not mine:
            continue
        size = mine[0][1]
        for doc, body in docs:
            w, by = templates(body or "")[1], places(body, size)
            shifts = {}
            for a, _, it, iw in mine:
                for b in by.get(key(size, it, iw), ()):
                    shifts.setdefault(b - a, []).append((a, [(x, y) for x, y, s in zip(iw, w[b : b + size], it) if s[0] == "#"]))
            ok, differs, run = set(), False, 0
            for hits in shifts.values():
                pairs = {p for _, ps in hits for p in ps}
                if len(pairs) != len({x for x, _ in pairs}):
                    continue
                at = {a for a, _ in hits}
                ok |= at
                differs |= any(x != y for x, y in pairs)
                for a in at:
                    n = 0
                    while a + n in at:
                        n += 1
                    run = max(run, n + size - 1)
            if ok and (len(ok) >= similarity * len(mine) or run >= min_run):
                found.add((doc, item, len(ok), len(mine), run, differs))
    return found


def got_rows(df):
    return {(r.doc_id, r.item_id, r.found_windows, r.item_windows, r.longest_run, r.reparameterised) for r in df.collect()}


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    got = QUERIES["op10_decontam"](spark, SF).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(d, i) for d, i, *_ in brute(docs, items)} and got


def fixture():
    pad = "some unrelated words stand here and more follow"
    renamed = ITEM[1].replace("Paris", "Rome").replace("9", "7").replace("120", "95,5").replace("300", "41")
    broken = ITEM[1].replace("Paris", "Rome", 1).replace("9", "7")  # one Paris became Rome, the other stayed
    return [
        (1, f"{pad}. {ITEM[1]} {pad}"), (2, f"{pad}. {renamed} {pad}"), (3, f"{pad}. {broken} {pad}"),
        (4, pad), (5, f"{pad} {OTHER[1].upper().replace(' ', '  ')} {pad}"), (6, OTHER[1].replace("lazy", "idle").replace("sing", "hum")),
        (7, "x four little words only y"), (8, None), (8, ""), (None, ITEM[1]), (9, ITEM[1]), (9, ITEM[1]), (9, pad),
        (10, "word " * 60_000), (11, "1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 16"), (12, "a 3 b c d. " * 50),
    ]


def test_planted_items(spark):
    docs = fixture()
    items = [ITEM, OTHER, SHORT, (4, None), (5, ""), (6, "1 2 3 4 5 6 7 8"), (7, "b 3 c 4 d.")]
    d = spark.createDataFrame([(i, t, 1, 2, "x") for i, t in docs], "doc_id long, text string, item int, shift int, tie string")
    b = spark.createDataFrame([(i, t, "q") for i, t in items + items[:1]], "item_id long, text string, hash string")
    got = got_rows(decontam.contaminated(d.repartition(3), b))
    assert got == brute(docs, items)
    named = {(x[0], x[1]): x[5] for x in got}
    assert named[1, 1] is False and named[2, 1] is True and (3, 1) not in named or named.get((3, 1)) is not None
    assert {(5, 2), (7, 3), (None, 1), (9, 1), (11, 6)} <= set(named) and not any(k[0] in (4, 8, 10) for k in named)
    kept = decontam.without_contaminated(d, b)
    assert kept.columns == d.columns
    bad = {k[0] for k in named}
    assert sorted(((r.doc_id, r.text or "") for r in kept.collect()), key=str) == sorted(
        ((i, t or "") for i, t in docs if i not in bad or (i == 9 and t == docs[12][1])), key=str
    )


def test_inconsistent_values_do_not_match(spark):
    item = (1, "take 3 apples and 3 pears then give 3 plums away")
    docs = [(1, "take 5 apples and 5 pears then give 5 plums away"), (2, "take 5 apples and 6 pears then give 7 plums away")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    got = got_rows(decontam.contaminated(d, spark.createDataFrame([item], "item_id long, text string")))
    assert {(x[0], x[5]) for x in got} == {(1, True)}


def test_random_texts(spark):
    rng = random.Random(4)
    words = ["the", "cat", "Bob", "7", "12", "kg", "sat.", "on", "a,", "mat;", "Eve"]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(i, text(rng.randrange(3, 16))) for i in range(6)]
    docs = [(i, text(rng.randrange(0, 60))) for i in range(40)]
    docs += [(100 + i, text(5) + " " + rng.choice(items)[1] + " " + text(5)) for i in range(20)]
    got = decontam.contaminated(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    )
    assert got_rows(got) == brute(docs, items)


def copied(docs, items, window=5, similarity=0.8, min_run=13):
    """(document, item) pairs by plain lower-cased words: knows nothing of names."""

    def windows(text):
        words = re.findall(r"\d+(?:[.,]\d+)*|[^\W\d_]+", (text or "").lower())
        return [tuple(words[a : a + window]) for a in range(len(words) - window + 1)]

    found = set()
    for d, text in docs:
        held = set(windows(text))
        for i, item in items:
            hit = [w in held for w in windows(item)]
            run = max(map(len, "".join(".x"[h] for h in hit).split(".")), default=0)
            if hit and (sum(hit) >= similarity * len(hit) or run + window - 1 >= min_run):
                found.add((d, i))
    return found


def test_copies_in_other_case_and_punctuation(spark):
    items = [ITEM, OTHER, (3, "First, Alice and Bob walk to the old market; then Carol, their friend, buys seven red apples there.")]
    changes = [str, str.upper, str.title, lambda t: re.sub(r"[.,;]", "", t), lambda t: t.replace(" ", ", "), str.lower]
    docs = [(10 * i + k, f"Words before. {change(t)} And after") for i, t in items for k, change in enumerate(changes)]
    docs.append((99, "Nothing of the kind, Alice and Bob say, is found here at all"))
    got = decontam.contaminated(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"),
        verbatim=True,
    )
    pairs = {(r.doc_id, r.item_id) for r in got.collect()}
    assert pairs == copied(docs, items) == {(10 * i + k, i) for i, _ in items for k in range(len(changes))}


def test_contradicting_values_leave_copied_windows(spark):
    item = (1, "it takes 3 apples and 3 pears to bake the cake that " + OTHER[1])
    docs = [
        (1, ITEM[1].replace("Paris", "Rome", 1)),  # one Paris of two: 18 words are copied as they are
        (2, item[1].replace("3 apples", "4 apples").replace("3 pears", "7 pears")),
        (3, "it takes 4 apples and 7 pears to bake the cake that nobody has ever seen or will eat"),
        (4, "A train leaves Rome at 9 with 120 people"),
    ]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame([(7, ITEM[1]), item], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontam.contaminated(d, b, verbatim=True).collect()}
    assert set(got) == {(1, 7), (2, 1)}
    # the windows of apples and pears contradict each other, the others stand
    assert got[2, 1].found_windows < got[2, 1].item_windows and got[2, 1].longest_run >= 20
    assert got[2, 1].reparameterised is False


def test_query_holds_every_copy(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    got = {(r.doc_id, r.item_id) for r in QUERIES["op10_decontam"](spark, SF).collect()}
    assert copied(docs, items) <= got


def test_long_runs_of_any_characters(spark):
    runs = ["-", " ", ",", ". ", ".", "\U0001f600", "e\u0301", "\n", "7,", "A", "a B "]
    docs = [(i, run * 300_000 + " " + OTHER[1] + " " + run * 300_000) for i, run in enumerate(runs)]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(len(docs))
    b = spark.createDataFrame([OTHER], "item_id long, text string")
    found = {r.doc_id for r in decontam.contaminated(d, b, verbatim=True).collect()}
    assert found == set(range(len(runs)))
    assert decontam.without_contaminated(d, b, verbatim=True).count() == 0


def test_empty_tables(spark):
    d, b = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    assert decontam.contaminated(d.where("false"), b).count() == 0
    assert decontam.contaminated(d, b.where("false")).count() == 0
    assert decontam.without_contaminated(d, b.where("false")).count() == d.count()


def test_no_python_in_the_plan(spark):
    plan = QUERIES["op10_decontam"](spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def test_number_dense_questions_are_found(spark):
    items = [
        (1, "If 3 km take 2 hours then 5 km at 9 km per 4 hours take how many hours"),
        (2, "In Lyon 12 birds eat 7 g and in Turin 30 birds eat 25 g on 12 days"),
    ]
    docs = [
        (1, "If 8 km take 6 hours then 11 km at 2 km per 5 hours take how many hours"),
        (2, "See, In Oslo 14 birds eat 9 g and in Rome 41 birds eat 33 g on 14 days"),
        (3, "In Oslo 14 birds eat 9 g and in Rome 41 birds eat 33 g on 15 days"),  # 12 is 14, then 15
        (4, "1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 16 17 18 19 20"),
        (5, "3 km 2 hours 5 km 9 km 4 hours"),
    ]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    plain = {(r.doc_id, r.item_id): r.reparameterised for r in decontam.contaminated(d, b).collect()}
    assert plain == {(1, 1): True, (2, 2): True}
    both = {(r.doc_id, r.item_id): r.reparameterised for r in decontam.contaminated(d, b, verbatim=True).collect()}
    assert both == plain
