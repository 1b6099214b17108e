"""Exact and near deduplication against brute force, with nulls, empty and long texts, repeated rows, ties and clashing columns."""

from __future__ import annotations

import hashlib
import os
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import exact_dedup, line_dedup, linking, ngram_join, words
from ledgerloom.llm.common import IdFilter, Scratch

DOCS = "doc_id long, text string"


def near_copies(rng, n_groups=6, size=7, words=120):
    vocabulary = [f"w{i}" for i in range(3000)]
    texts = []
    for _ in range(n_groups):
        base = [rng.choice(vocabulary) for _ in range(words)]
        for _ in range(size):
            own = list(base)
            for _ in range(rng.randint(0, 5)):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            texts.append(" ".join(own))
    return texts


def brute_components(texts, size, percent):
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(fold))
        sets.append({tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [len(s) for s in sets], [find(i) for i in range(len(texts))]


def test_components(spark):
    pairs = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 130)] + [(7, 7), (None, 3), (200, 201), (201, 200)]
    got = {r.id: r.component for r in linking.components(Scratch(spark, "t"), spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(1, 41), 1), **dict.fromkeys(range(100, 130), 100), 200: 200, 201: 200}
    assert linking.components(Scratch(spark, "t"), spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("rounds,listed,sizes", [(2, 2, 1), (3, 0, 1), (0, 0, 1), (4, 0, 9), (1, 2, 9)])
def test_links_in_buckets_lose_no_component(spark, rounds, listed, sizes):
    rng = random.Random(rounds + listed)
    size = {i: rng.randrange(sizes) for i in range(60)}
    rows = [(b, i, size[i], size[i] + rng.randrange(3), rng.randrange(1, 3)) for b in range(12) for i in rng.sample(range(60), 25)]
    links = {(a, b) for a in range(60) for b in range(a) if (a * 7 + b * 13) % 29 == 0}
    most = {(b, i): m for b, i, _, m, _ in rows}
    root = {i: i for i in range(60)}
    for _ in range(60):
        for a, b in links:
            if any((k, a) in most and (k, b) in most and size[a] <= most[k, b] and size[b] <= most[k, a] for k in range(12)):
                root[a] = root[b] = min(root[a], root[b])
    known = spark.createDataFrame([(min(p), max(p)) for p in links], "a long, b long")
    scratch = Scratch(spark, "t")
    asked = []

    def verify(pairs):
        asked.append(pairs.count())
        return scratch.cut(pairs.join(known, ["a", "b"], "left_semi"), "links")

    out = linking.link_in_buckets(scratch, spark.createDataFrame(rows, "bucket long, id long, n long, most long, weight long"), verify, rounds=rounds, listed=listed)
    got = {r.id: r.component for r in out.collect()}
    assert {i: got.get(i, i) for i in range(60)} == root


def test_large_groups_are_not_joined_with_themselves(spark):
    """A group around one item, and items that share its buckets but nothing else: pairs stay near the number of rows."""
    n = 400
    rows = [(b, i, 100, 100 if i < n else 99, 9 if i == 7 else 1) for b in range(3) for i in range(2 * n)]
    rows += [(b, 2 * n, 100, 100, 1) for b in range(3)]
    asked = []
    scratch = Scratch(spark, "t")

    def verify(pairs):
        asked.append(pairs.count())
        return scratch.cut(pairs.filter(f"least(a, b) < {n} AND greatest(a, b) < {n}"), "links")

    out = linking.link_in_buckets(scratch, spark.createDataFrame(rows, "bucket long, id long, n long, most long, weight long"), verify)
    assert {r.id: r.component for r in out.collect()} == dict.fromkeys(range(n), 0)
    assert sum(asked) <= 3 * n


@pytest.mark.parametrize("size,percent", [(4, 85), (5, 80)])
def test_ngram_join_against_brute_force(spark, size, percent):
    texts = near_copies(random.Random(percent)) + [None, "", "  \n", "one", "ONE", "One two", "a b c d e f", "A\tb  c d\ne f", "long " + " ".join(f"x{i}" for i in range(20_000))]
    texts += ["common passage of many words " * 3 + t for t in near_copies(random.Random(1), 10, 1, 40)] + texts[:3]
    sizes, roots = brute_components(texts, size, percent)
    df = spark.createDataFrame(list(enumerate(texts)), DOCS).withColumn("n", F.lit("x")).withColumn("id", F.lit(None).cast("int")).repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.ngram_components(spark, df, size, percent, frequent=64).collect()}
    assert got == {i: (n, r) for i, (n, r) in enumerate(zip(sizes, roots))}
    kept = ngram_join.one_of_each(spark, df, size, percent)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == sorted(set(roots))


def test_parities_refuse_most_pairs_of_a_group_near_the_threshold(spark, monkeypatch):
    """Copies that share most prefixes under every order, but differ too much: few of their pairs are made, and no link is lost."""
    rng = random.Random(3)
    base = [f"w{i}" for i in range(200)]
    changed = lambda k: " ".join(w if i not in at else f"{w}x{rng.randrange(9**9)}" for at in [set(rng.sample(range(200), k))] for i, w in enumerate(base))
    texts = [changed(8) for _ in range(50)] + [changed(2) for _ in range(6)]
    asked = []

    def counted(scratch, rows, verify, *more, **named):
        return linking.link_in_buckets(scratch, rows, lambda pairs: (asked.append(pairs.count()), verify(pairs))[1], *more, **named)

    monkeypatch.setattr(ngram_join, "link_in_buckets", counted)
    got = {r.doc_id: r.component_id for r in ngram_join.ngram_components(spark, spark.createDataFrame(list(enumerate(texts)), DOCS)).collect()}
    _, roots = brute_components(texts, 4, 85)
    assert got == dict(enumerate(roots)) and len(set(roots)) > 10
    assert sum(asked) < 400 < 56 * 55 // 2


def test_parities_admit_every_link():
    rng = np.random.default_rng(5)
    places = range(len(ngram_join.PARITY))
    refused = 0
    for n, percent in [(1, 80), (7, 85), (60, 80), (300, 85), (3000, 80)] * 20:
        one = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        cut = rng.integers(0, len(one) + 1)
        two = np.unique(np.concatenate([one[: len(one) - cut // 6], rng.integers(0, 1 << 63, cut // 7, dtype=np.uint64)]))
        both = np.intersect1d(one, two).size
        a, b = ngram_join.parities([one, two])
        admitted = sum((int(a[i] ^ b[i]) & (2**64 - 1)).bit_count() for i in places) * (100 + percent) <= (100 - percent) * (one.size + two.size)
        assert admitted or 100 * both < percent * (one.size + two.size - both)
        refused += not admitted
    assert refused and ngram_join.parities([]).shape == (0, len(places)) and not ngram_join.parities([np.zeros(0, np.uint64)]).any()


def test_ngram_join_of_odd_rows(spark):
    got = ngram_join.ngram_components(spark, spark.createDataFrame([(None, "a b c d e"), (None, None), (5, "a b c d e"), (5, "z")], DOCS)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(None, 2, None), (None, 0, None), (5, 2, 5), (5, 1, 5)], key=repr)
    assert ngram_join.ngram_components(spark, spark.createDataFrame([], DOCS)).count() == 0


def test_ngram_join_of_repeated_ids(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(3, text), (5, text + " more"), (5, "a text of its own"), (5, "a text of its own"), (None, text), (None, "left alone"), (None, None), (9, ""), (7, text)]
    df = spark.createDataFrame(rows, DOCS).withColumn("h1", F.lit("mine")).withColumn("class", F.lit(1)).repartition(3)
    got = sorted(((r.doc_id, r.component_id) for r in ngram_join.ngram_components(spark, df).collect()), key=repr)
    assert got == sorted([(3, 3), (5, 3), (5, 5), (5, 5), (None, None), (None, None), (None, None), (9, 9), (7, 3)], key=repr)
    kept = ngram_join.one_of_each(spark, df)
    assert kept.columns == df.columns and {r.h1 for r in kept.collect()} == {"mine"}
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted([r for i, r in enumerate(rows) if i not in (1, 8)], key=repr)
    assert ngram_join.one_of_each(spark, df.limit(0)).count() == 0


def test_long_texts_are_hashed_in_parts(monkeypatch):
    text = b" ".join(b"w%d" % (i % 700) for i in range(3000)) + b" " + b"q" * 2500 + b" and more"
    whole = ngram_join.shingles([text, b"a b", None], 4)
    monkeypatch.setattr(words, "PART_BYTES", 1000)
    parts = ngram_join.shingles([text, b"a b", None], 4)
    assert [list(x) for x in whole] == [list(x) for x in parts]


def test_id_filter(spark):
    held = IdFilter.of(spark.createDataFrame([(5,), (None,), (-7,)], "id long"))
    at = spark.createDataFrame([(5,), (-7,), (8,)], "id long").select(IdFilter.position("id").alias("at")).toArrow()
    assert held.mask(at.column(0).combine_chunks()).to_pylist() == [True, True, False]


def brute_exact(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    out = []
    for (i, _), t in zip(rows, norm):
        ids = [j for (j, _), u in zip(rows, norm) if u == t]
        keep = min((j for j in ids if j is not None), default=None)
        out.append((i, keep, len(ids), i == keep))
    return sorted(out, key=repr)


@pytest.mark.parametrize("primes,bases,size", [(exact_dedup.PRIMES, exact_dedup.BASES, 64), ((7, 5), (3, 2), 3)], ids=["real", "colliding"])
def test_exact_dedup(spark, primes, bases, size):
    rows = [(4, "a  b"), (2, "a\tb"), (9, "a b "), (3, None), (1, ""), (7, " "), (None, "a b"), (None, "q"), (6, "é" * 200), (8, "é" * 200), (5, "e" * 400), (2, "a b")] + [(20 + i, "xyz"[i % 3] * (1 + i % 4)) for i in range(40)]
    df = spark.createDataFrame(rows, DOCS).withColumn("keep_id", F.lit(1)).repartition(4)
    out = exact_dedup.exact_dedup(spark, df, primes, bases, size).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in out), key=repr) == brute_exact(rows)
    assert exact_dedup.exact_dedup(spark, spark.createDataFrame([], DOCS)).count() == 0


def test_chunks_of_a_long_text_are_hashed_in_several_tasks(spark, tmp_path, monkeypatch):
    plain, log = exact_dedup.Fingerprints.chunk, str(tmp_path)

    class Logged(exact_dedup.Fingerprints):
        def chunk(self, data):
            from pyspark import TaskContext

            open(f"{log}/{TaskContext.get().partitionId()}", "w").close()
            return plain(self, data)

    rows = [(1, "ab  c" * 60), (2, "ab c" * 60), (3, "ab c" * 59 + "ab d"), (4, "short"), (None, "x" * 300), (5, None)]
    df = spark.createDataFrame(rows, DOCS).coalesce(1)
    got = sorted(map(tuple, exact_dedup.digests(df, size=8).collect()), key=repr)
    prints = exact_dedup.Fingerprints(size=8)
    texts = [(i, exact_dedup.normalise((t or "").encode())) for i, t in rows]
    assert got == sorted(((i, *prints.of(t), hashlib.sha256(t).hexdigest()) for i, t in texts), key=repr)
    monkeypatch.setattr(exact_dedup, "_fingerprints", lambda *args: Logged(*args))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert sorted(map(tuple, exact_dedup.digests(df.filter("doc_id = 1"), size=8).collect()), key=repr) == got[:1]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(list(tmp_path.iterdir())) > 1


def test_fingerprints_compose():
    prints = exact_dedup.Fingerprints(size=8)
    text = b"the quick brown fox jumps"
    for cut in range(0, 8):
        left, right = text[:cut], text[cut : cut + 8]
        assert prints.combine(prints.chunk(left), prints.chunk(right)) == (exact_dedup.Fingerprints(size=32).chunk(text[: cut + 8]))


def brute_lines(rows):
    lines = [(d is None, d, n, x.strip(" ").lower()) for d, t in rows for n, x in enumerate((t or "").split("\n"))]
    k = line_dedup.SHINGLE
    sets = {x: {x[i : i + k] for i in range(len(x) - k + 1)} for _, _, _, x in lines}
    names = sorted(sets)
    root = {x: x for x in names}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(names):
        for b in names[:i]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= line_dedup.PERCENT * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    first = {}
    for null, d, n, x in sorted(lines, key=lambda r: (r[0], r[1] or 0, r[2])):
        first.setdefault(find(x), (d, n))
    return {(d, n): not x or first[find(x)] == (d, n) for _, d, n, x in lines}


def test_lines_with_a_changed_character(spark):
    size = 5  # fixed here, so that a coarser comparison in the module shows
    rng = random.Random(8)
    bases = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(rng.randint(61, 250))).strip() + "." for _ in range(120)]
    rows, expected = [], {}
    for i, base in enumerate(bases):
        at = rng.randrange(8, len(base) - 8)
        copy = base[:at] + "#" + base[at + 1 :]
        a, b = ({x[k : k + size] for k in range(len(x) - size + 1)} for x in (base, copy))
        rows += [(2 * i, base), (2 * i + 1, copy)]
        expected[2 * i + 1] = 100 * len(a & b) < line_dedup.PERCENT * len(a | b)
    got = {r.doc_id: r.kept for r in line_dedup.line_classes(spark, spark.createDataFrame(rows, DOCS)).collect()}
    assert sum(not x for x in expected.values()) > 100
    assert all(got[2 * i] for i in range(len(bases)))
    assert sum(got[i] != kept for i, kept in expected.items()) <= 2


def test_repetitive_lines_of_different_length(spark):
    lines = [(unit * 400)[:n] for unit in ("* ", "- - ", "ha ha ", "ab", "=") for n in (21, 39, 199, 701)]
    got = [r.kept for r in line_dedup.line_classes(spark, spark.createDataFrame(list(enumerate(lines)), DOCS)).orderBy("doc_id").collect()]
    sets = [{x.strip()[i : i + 5] for i in range(len(x.strip()) - 4)} for x in lines]
    assert got == [s not in sets[:i] for i, s in enumerate(sets)]


def test_unlike_lines_are_not_compared_shingle_by_shingle(spark, monkeypatch):
    """Lines of one template that share half of their shingles meet in many bands; before, all their pairs had their sets made."""
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("bcdfghklmnprst") + rng.choice("aeiou") for _ in range(3))
    base = [word() for _ in range(60)]
    lines = []
    for _ in range(40):
        own = list(base)
        for at in rng.sample(range(60), 12):
            own[at] = word()
        lines.append(" ".join(own))
    lines += [f"{x[:100]}#{x[101:]}" for x in lines[:5]]
    written, cut = {}, Scratch.cut

    def counted(self, df, label, **kwargs):
        back = cut(self, df, label, **kwargs)
        written[label] = written.get(label, 0) + back.count()
        return back

    monkeypatch.setattr(Scratch, "cut", counted)
    got = [r.kept for r in line_dedup.line_classes(spark, spark.createDataFrame(list(enumerate(lines)), DOCS)).orderBy("doc_id").collect()]
    assert got == [True] * 40 + [False] * 5
    assert written["links"] == 5 and written["alike"] < 100


def test_shingles_of_bytes_are_those_of_strings(spark):
    texts = ["", "abcd", "abcde", "ha ha ha ha", "stra\u00dfe und weg", "\U0001f600 ha ha \U0001f600 ha", "tab\tand\x00nul"]
    found = spark.createDataFrame([(x,) for x in texts], "text string").select("text", line_dedup.shingles_of(F.col("text")).alias("s")).collect()
    sets = {x: {x[i : i + 5] for i in range(len(x) - 4)} for x in texts}
    names = sorted({g for s in sets.values() for g in s})
    of = {r.g: r.h for r in spark.createDataFrame([(g,) for g in names], "g string").selectExpr("g", "xxhash64(g) AS h").collect()}
    assert all(len(r.s) == len(set(r.s)) and set(r.s) == {of[g] for g in sets[r.text]} for r in found)


def test_fuzzy_lines(spark):
    rng = random.Random(3)
    lines = []
    for t in near_copies(rng, 12, 1, 60):
        for _ in range(4):
            c = list(t[: rng.choice([60, 110, 130, 300])])
            for _ in range(rng.randint(0, 1)):
                c[rng.randrange(len(c))] = "#"
            lines.append("".join(c))
    rows = [(i, "\n".join([*rng.sample(lines, 5), "", "short", "Short "])) for i in range(20)] + [(None, lines[0]), (90, None), (91, ""), (92, "長い行には空白がありませんのでワードはひとつだけです" * 3), (93, "長い行には空白がありませんのでワードはひとつだけです" * 3)]
    df = spark.createDataFrame(rows, DOCS).withColumn("line", F.lit(1)).repartition(3)
    got = {(r.doc_id, r.line_no): r.kept for r in line_dedup.line_classes(spark, df).collect()}
    expected = brute_lines(rows)
    assert set(got) == set(expected)
    wrong = [k for k in got if got[k] != expected[k]]
    assert len(wrong) <= 0.01 * len(got)  # banding finds a pair at the threshold in 993 of 1000 cases
    cut = {r.doc_id: r.text for r in line_dedup.dedup_lines(spark, df).collect()}
    assert line_dedup.dedup_lines(spark, df).columns == df.columns
    assert cut[90] is None and cut[91] == "" and all(len(cut[i].split("\n")) == sum(got[i, n] for n in range(8)) for i in range(20))
    assert line_dedup.kept_lines(spark, spark.createDataFrame([], DOCS)).count() == 0


def test_lines_of_repeated_ids(spark):
    again = "this is a repeated line of text"
    rows = [(1, again), (7, again + "\na unique first line of the other seven\nsecond"), (7, "one more text\n" + again), (7, "one more text\n" + again), (None, again + "\nmine"), (None, "other\n" + again), (None, None), (8, "")]
    df = spark.createDataFrame(rows, DOCS).withColumn("dropped", F.lit("x")).repartition(3)
    cut = line_dedup.dedup_lines(spark, df)
    assert cut.columns == df.columns
    expected = [(1, again), (7, "a unique first line of the other seven\nsecond"), (7, "one more text"), (7, "one more text"), (None, "mine"), (None, "other"), (None, None), (8, "")]
    assert sorted(((r.doc_id, r.text) for r in cut.collect()), key=repr) == sorted(expected, key=repr)
    counts = line_dedup.kept_lines(spark, df).collect()
    assert sorted((r.n_lines, r.n_kept) for r in counts) == sorted([(1, 1), (3, 2), (2, 1), (2, 1), (2, 1), (2, 1), (0, 0), (0, 0)])


def test_a_text_of_some_megabytes(spark):
    long = "\n".join(f"{i * i * 7919} " * 30 + f"line {i}" for i in range(8_000))
    df = spark.createDataFrame([(1, long), (2, long + " "), (3, "line 5")], DOCS)
    got = {r.doc_id: (r.n_lines, r.n_kept) for r in line_dedup.kept_lines(spark, df).collect()}
    assert got[1][0] == 8_000 and got[2] == (8_000, 0) and got[3] == (1, 1)
    assert {r.doc_id: r.component_id for r in ngram_join.ngram_components(spark, df).collect()} == {1: 1, 2: 1, 3: 3}


SF = "/root/testdata/sf0.01"


@pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")
def test_recall_of_lines_by_length(spark):
    """All links of the table's lines, found by the rarest fifth of each line's shingles, against the classes."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    lines = sorted({x.strip(" ").lower() for r in docs.collect() for x in (r.text or "").split("\n")} - {""})
    sets = [{x[i : i + 5] for i in range(len(x) - 4)} for x in lines]
    counts = Counter(g for s in sets for g in s)
    held: dict[str, list[int]] = {}
    links: dict[str, list] = {}
    for i, s in enumerate(sets):
        prefix = sorted(s, key=lambda g: (counts[g], g))[: len(s) - -(-len(s) * 4 // 5) + 1]
        for j in {j for g in prefix for j in held.get(g, ())}:
            if 5 * len(s & sets[j]) >= 4 * len(s | sets[j]):
                links.setdefault("short" if len(lines[i]) < 68 else "long", []).append((i, j))
        for g in prefix:
            held.setdefault(g, []).append(i)
    ids = {r.norm: r.id for r in spark.createDataFrame([(x,) for x in lines], "norm string").selectExpr("norm", "xxhash64(norm) AS id").collect()}
    of = {r.line_id: r.class_id for r in line_dedup.line_classes(spark, docs).select("line_id", "class_id").distinct().collect()}
    assert sum(map(len, links.values())) > 100
    for found in links.values():
        assert sum(of[ids[lines[i]]] == of[ids[lines[j]]] for i, j in found) >= 0.99 * len(found)
    root = list(range(len(lines)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in (x for found in links.values() for x in found):
        root[max(find(i), find(j))] = min(find(i), find(j))
    truth: dict[int, int] = {}
    assert all(truth.setdefault(of[ids[x]], find(i)) == find(i) for i, x in enumerate(lines))


def test_marks_tell_lines_apart_in_their_bucket(spark):
    """Copies changed up to the threshold are admitted, unlike lines of one vocabulary refused; parities of all shingles refuse no link."""
    rng = random.Random(4)
    words = ["".join(rng.choice("bcdfghklmnprst") + rng.choice("aeiou") for _ in range(rng.randint(1, 3))) for _ in range(400)]
    shingles = lambda x: {x[i : i + 5] for i in range(len(x) - 4)}
    rows = []
    for n in (8, 20, 40, 60, 150, 250):
        for _ in range(40):
            base = [rng.choice(words) for _ in range(n)]
            for tries in (n // 12, n // 3):
                copy = list(base)
                for _ in range(tries):
                    copy[rng.randrange(n)] = rng.choice(words)
                rows.append((" ".join(base), " ".join(copy)))
    alike = {(x, y): len(shingles(x) & shingles(y)) / len(shingles(x) | shingles(y)) for x, y in rows}
    df = spark.createDataFrame([(i, k, x) for i, (a, b) in enumerate(rows) for k, x in enumerate((a, b))], "i long, k int, t string")
    marked = line_dedup.with_bands(df.withColumn("all", line_dedup.shingles_of(F.col("t"))), "t").withColumn("prints", line_dedup.prints_of("all"))
    side = lambda k, p: marked.filter(f"k = {k}").select("i", *(F.col(c).alias(p + c) for c in ("t", *line_dedup.MARKS, "prints")))
    both = side(0, "x_").join(side(1, "y_"), "i")
    near = line_dedup.near(line_dedup.PERCENT)("x_", "y_")
    first = both.withColumns({f"{p}prints": F.lit(None).cast("array<bigint>") for p in ("x_", "y_")})
    got = {(r.x_t, r.y_t): r.ok for r in first.selectExpr("x_t", "y_t", f"{near} AS ok").collect()}
    last = {(r.x_t, r.y_t): r.ok for r in both.withColumn("x_marked", F.lit(0)).selectExpr("x_t", "y_t", f"{near} AS ok").collect()}
    links, unlike = [p for p, s in alike.items() if s >= 0.8], [p for p, s in alike.items() if s < 0.5]
    assert len(links) > 100 and len(unlike) > 100
    assert all(last[p] for p in links) and sum(got[p] for p in links) >= 0.99 * len(links)
    assert sum(got[p] for p in unlike) < 0.2 * len(unlike) and sum(last[p] for p in unlike) < 0.05 * len(unlike)
