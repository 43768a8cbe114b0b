"""The pipeline against a brute-force version of its five stages."""

import random
from collections import defaultdict

from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from pathwise.llm import decontaminate, jaccard_join, line_dedup, packing

from test_operators import ascii_lower, near_components, split

ENGLISH = ("the of and house river stone light there which water through winter morning garden they would "
           "should thought because children forest evening little window").split()
GERMAN = ("der und nicht haus straße licht stein auch wasser durch winterzeit morgen garten sie würde "
          "sollte gedanke weil kinder wald abend kleine fenster zwischen").split()


def written(rng, bank, n):
    return " ".join(rng.choice(bank) for _ in range(n))


def fixture_rows():
    rng = random.Random(11)
    items = [(i, written(rng, ENGLISH, rng.randint(20, 50))) for i in range(6)] + [(50, None), (51, "")]
    rows = []
    for i in range(60):
        lang, bank = (("en", ENGLISH), ("de", GERMAN))[i % 2]
        rows.append((i, written(rng, bank, rng.randint(40, 160)), lang, f"site{i % 3}"))
    for i in range(60, 90):  # near copies, also of one another
        _, text, lang, source = rng.choice(rows[:60])
        ws = text.split()
        for _ in range(rng.randint(1, 3)):
            ws[rng.randrange(len(ws))] = rng.choice(ENGLISH)
        rows.append((i, " ".join(ws), lang, source))
    for i in range(90, 100):  # exact copies, in another case
        _, text, lang, source = rng.choice(rows[:60])
        rows.append((i, text.upper() if i % 2 else text, lang, source))
    for i in range(100, 106):
        rows.append((i, f"{written(rng, ENGLISH, 30)} {items[i - 100][1]} {written(rng, ENGLISH, 20)}", "en", "site0"))
    rows += [(200, None, "en", "site0"), (201, "", "en", "site1"), (202, " \n ", None, None), (203, "12 34 56", None, None),
             (204, written(rng, ENGLISH, 4000), "en", "site2")]
    return rows, items


def brute_force(rows, items):
    """{doc_id: text} of the documents that reach packing."""
    kept = [(i, t) for i, t, *_ in rows if t and any(c.isalpha() for c in t)]
    last = {}
    for i, t in kept:
        last[ascii_lower(t)] = max(i, last.get(ascii_lower(t), i))
    kept = {i: t for i, t in kept if last[ascii_lower(t)] == i}
    sets = {}
    for i, t in kept.items():
        ws = split(ascii_lower(t))
        sets[i] = {tuple(ws[j:j + 5]) for j in range(max(1, len(ws) - 4))}
    group = near_components(sets, 80, 100)
    kept = {i: t for i, t in kept.items() if group[i] == i}
    bench = decontaminate.Benchmark([x for x in items if x[1]], {})

    def leaks(text):
        h = decontaminate.word_hashes(decontaminate.words(text, lower=True))
        s = decontaminate.shingle_hashes(h, 5).tolist() if len(h) >= 5 else []
        return any(bench.similarity(s[a:a + n], i) >= 0.8 for i, size in enumerate(bench.sizes)
                   for n in [min(int(size), len(h)) - 4] for a in range(len(s) - n + 1))

    return {i: t for i, t in kept.items() if not leaks(t)}


def test_pipeline(spark, tmp_path):
    rows, items = fixture_rows()
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    (spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], columns).repartition(4)
     .write.parquet(f"{tmp_path}/documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    want = brute_force(rows, items)
    assert 20 < len(want) < 85 and 204 in want and not {200, 201, 202, 203, 100, 105} & set(want)

    encode = Tokenizer.from_file(packing.default_tokenizer_path()).encode
    pieces = defaultdict(list)
    for r in corpus_pipeline.run(spark, str(tmp_path)).collect():
        pieces[r.doc_id].append((r.start, r.ids))
    assert set(pieces) == set(want)
    for i, text in want.items():
        assert sum((ids for _, ids in sorted(pieces[i])), []) == encode(text, add_special_tokens=False).ids + [1]


def test_stages_keep_the_columns(spark, tmp_path):
    rows, items = fixture_rows()
    extra = ("doc_id long, text string, lang string, source string, n_chars long, a long, component string, _id string, "
             "_own string, _gone long, _keep string, _key long, _leak string")
    docs = spark.createDataFrame([(*r, 1, 2, "x", "y", "z", 3, "k", 4, "l") for r in rows], extra)
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, fn in corpus_pipeline.STAGES[:-1]:
        out = fn(spark, docs, str(tmp_path))
        assert out.columns == docs.columns and 0 < out.count() < docs.count(), name


def test_empty_documents(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_dropped_lines_keep_the_columns(spark):
    line = "a line that is long enough to be told from every other"
    docs = spark.createDataFrame([(1, line, "x", 5), (2, f"own\n{line}", None, 6), (3, None, "y", None)],
                                 "doc_id long, text string, _id string, _gone long")
    out = line_dedup.drop_lines(docs, line_dedup.dedup_lines(docs))
    assert sorted(map(tuple, out.collect()), key=lambda r: r[0]) == [
        (1, line, "x", 5), (2, "own", None, 6), (3, None, "y", None)]


ROWS = "doc_id long, text string, _mark string, _own int, _text_sha256 string"


def test_stages_drop_by_id_and_text(spark):
    """Null and repeated ids: a dropped row takes no other text with it."""
    rng = random.Random(4)
    long = [" ".join(f"w{rng.randint(0, 999)}" for _ in range(80)) for _ in range(6)]
    near = long[0].replace(long[0].split()[40], "other", 1)
    rows = [(5, long[0]), (7, near), (7, long[1]), (5, long[2]), (None, long[3]), (None, near), (8, near),
            (9, None), (9, ""), (10, long[4]), (10, long[4])]
    df = spark.createDataFrame([(i, t, "m", 1, "s") for i, t in rows], ROWS).repartition(3)
    got = sorted(((r.doc_id, r.text) for r in jaccard_join.drop_near_copies(df).collect()), key=str)
    gone = [(7, near), (8, near)]
    assert got == sorted((r for r in rows if r not in gone), key=str)
    bench = spark.createDataFrame([(1, long[3]), (2, long[1])], "item_id long, text string")
    got = sorted(((r.doc_id, r.text) for r in decontaminate.drop_leaks(df, bench).collect()), key=str)
    assert got == sorted((r for r in rows if r[1] not in (long[3], long[1])), key=str)
    none = df.limit(0)
    assert jaccard_join.drop_near_copies(none).count() == 0
    assert decontaminate.drop_leaks(none, bench).count() == 0
    assert decontaminate.drop_leaks(df, bench.limit(0)).count() == len(rows)


def test_jaccard_groups_of_repeated_ids(spark):
    """One id under two texts links neither with the other's copies."""
    rng = random.Random(5)
    a, b, c = (" ".join(f"w{rng.randint(0, 999)}" for _ in range(60)) for _ in range(3))
    rows = [(3, a), (3, b), (4, a + " end"), (6, b + " end"), (2, c), (2, c), (None, a)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.jaccard_groups(df).collect()), key=str)
    assert got == sorted([(3, 58, 3), (3, 58, 3), (4, 59, 3), (6, 59, 3), (2, 58, 2), (2, 58, 2), (None, 58, None)], key=str)


def test_near_copies_without_their_original_meet_few_times(spark, monkeypatch):
    """Copies with the same few edits each are in equally many lists, and none
    is near all others: their pairs must not all be set against each other."""
    rng = random.Random(8)
    base = [f"w{rng.randint(0, 9999)}" for _ in range(150)]
    rows = []
    for i in range(400):
        copy = list(base)
        for at in rng.sample(range(2, 148, 6), 3):
            copy[at] = f"x{at}"
        rows.append((i, " ".join(copy)))
    rows.append((400, " ".join(f"v{rng.randint(0, 9999)}" for _ in range(150))))
    candidates, stage = [], jaccard_join.stage

    def counted(df, label):
        out = stage(df, label)
        if label == "jaccard-candidates":
            candidates.append(out.count())
        return out

    monkeypatch.setattr(jaccard_join, "stage", counted)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: r.component_id for r in jaccard_join.jaccard_groups(df, k=5, num=80).collect()}
    sets = {}
    for i, t in rows:
        w = t.split()
        sets[i] = {tuple(w[j:j + 5]) for j in range(len(w) - 4)}
    parent = dict.fromkeys(sets)
    for first in sorted(sets):  # reached from the smallest id on
        todo = [first] if parent[first] is None else []
        while todo:
            i = todo.pop()
            parent[i] = first
            todo += [j for j in sets if parent[j] is None and j not in todo
                     and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    assert got == parent
    assert candidates[0] <= len(rows), candidates


def test_short_lists_take_no_rounds(spark, monkeypatch):
    """Lists of few sets go to the last step at once, and no link is lost there."""
    rng = random.Random(9)
    rows = []
    for group in range(6):  # copies of a text that is not there, with two of four edits each
        base = [f"w{rng.randint(0, 9999)}" for _ in range(120)]
        for i in range(5):
            copy = list(base)
            for at in rng.sample(range(10, 110, 25), 2):
                copy[at] = f"x{group}"
            rows.append((10 * group + i, " ".join(copy)))
    labels, stage = [], jaccard_join.stage
    monkeypatch.setattr(jaccard_join, "stage", lambda df, label: labels.append(label) or stage(df, label))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.component_id for r in jaccard_join.jaccard_groups(df).collect()}
    sets = {}
    for i, t in rows:
        w = t.split()
        sets[i] = {tuple(w[j:j + 3]) for j in range(len(w) - 2)}
    want = {i: i for i in sets}
    for _ in sets:
        for i in sets:
            want[i] = min(want[j] for j in sets if 100 * len(sets[i] & sets[j]) >= 90 * len(sets[i] | sets[j]))
    assert got == want and 6 < len(set(want.values())) < len(rows)
    assert "jaccard-candidates" in labels and "jaccard-more" not in labels, labels


def test_only_wanted_texts_are_shuffled(spark):
    ids = spark.range(20000).select(F.when(F.col("id") != 5, F.col("id")).alias("doc_id"))
    wanted = spark.range(0, 20000, 100).select(F.col("id").alias("a"))
    left = [r.doc_id for r in jaccard_join._only(ids, "doc_id", wanted).collect()]
    assert len(left) < 300 and {r.a for r in wanted.collect()} <= set(left)
    assert jaccard_join._only(ids, "doc_id", wanted.limit(0)).count() == 0


def test_shingle_sets_of_many_texts():
    rng = random.Random(10)
    texts = ["", "a", "a b", "A b\tc D", " \n"] + [" ".join(rng.choices("abcdefg", k=rng.randint(0, 40))) for _ in range(200)]
    for k in (1, 3, 5):
        got = [s.tolist() for s in jaccard_join.shingle_sets(texts, k)]
        assert got == [sorted(set(jaccard_join.shingle_set(t, k).tolist())) for t in texts]
    assert list(jaccard_join.shingle_sets([], 3)) == []
