"""Fingerprints, spelling variants and ranked search: brute force, nulls, repeats, ties, empty tables and clashing columns."""

import hashlib
import itertools
import math
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from pointmill.llm import fingerprints, ranked_search, spelling

CLASH = "id", "row", "text_", "term", "task", "place", "word", "n", "query", "block", "fingerprint", "tie"
LONG = " ".join(f"word{k % 977} x{k}" for k in range(30_000))
TEXTS = [(1, "one two three four"), (1, "one two three four"), (2, None), (3, ""), (4, "é"), (5, LONG), (6, LONG), (None, "no id here"), (8, "a🙂b" * 9), (9, "Ünïted ÜNÏTED"), (10, "  \n\t")]


def clashing(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema).selectExpr("*", *[f"'clash' AS {c}" for c in CLASH])


def plain_fingerprint(data):
    counts = [0] * 512
    for a, b, c in zip(data, data[1:], data[2:], strict=False):
        counts[((a + 1) * 2654435761 + (b + 1) * 2246822519 + (c + 1) * 3266489917) % 2**32 >> 23] += 1
    limits = [sorted(counts)[k] for k in (127, 255, 383)]
    codes = [sum(c > x for x in limits) for c in counts]
    return [min(255, math.floor(8 * math.log2(len(data) + 1))), codes]


def written(size_and_codes):
    size, codes = size_and_codes
    return f"{size:02x}" + "".join(f"{64 * a + 16 * b + 4 * c + d:02x}" for a, b, c, d in itertools.batched(codes, 4))


def plain_likeness(left, right):
    difference = 16 * abs(left[0] - right[0]) + sum(abs(a - b) for a, b in zip(left[1], right[1], strict=True))
    return (640 - min(640, difference)) / 640


@pytest.mark.parametrize("partitions", [1, 4, 40])
def test_fingerprints_against_brute_force(spark, partitions):
    docs = clashing(spark, TEXTS).repartition(partitions)
    ordered = sorted(TEXTS, key=lambda r: (r[0] is None, -(r[0] or 0)))
    want = []
    for k, (name, text) in enumerate(ordered):
        text, following = text or "", ordered[(k + 1) % len(ordered)][1] or ""
        changed = text[: len(text) - len(text) // 3] + following[: len(text) // 3]
        own, edited, after = (plain_fingerprint(t.encode()) for t in (text, changed, following))
        want.append((name, len(text), hashlib.sha256(changed.encode()).hexdigest(), written(own), written(edited), plain_likeness(own, edited), plain_likeness(own, after)))
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        found = [tuple(r) for r in fingerprints.edit_report(docs).collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sorted(found, key=str) == sorted(want, key=str)


def test_fingerprints_of_one_and_no_document(spark):
    docs = clashing(spark, [(7, "abcdef")])
    (row,) = fingerprints.edit_report(docs).collect()
    assert (row.edited_sha256, row.near_next) == (hashlib.sha256(b"abcdab").hexdigest(), 1.0)
    assert fingerprints.edit_report(docs.limit(0)).count() == 0
    assert fingerprints.fingerprints(docs.limit(0)).count() == 0


def test_fingerprint_columns(spark):
    docs = clashing(spark, TEXTS)
    made = fingerprints.fingerprints(docs)
    assert made.columns == ["doc_id", "n_chars", "fingerprint"]
    rows = sorted((str(r.doc_id), r.n_chars, r.fingerprint) for r in made.collect())
    assert rows == sorted((str(i), len(t or ""), written(plain_fingerprint((t or "").encode()))) for i, t in TEXTS)
    pairs = spark.createDataFrame([(rows[0][2], rows[1][2]), (rows[2][2], None), (rows[3][2], rows[3][2])], "a string, b string")
    found = [r[0] for r in pairs.select(fingerprints.likeness_column(pairs.a, pairs.b)).collect()]
    assert found[1:] == [None, 1.0] and 0 <= found[0] <= 1


def test_edited_texts_are_nearer_than_others(spark):
    rows = fingerprints.edit_report(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).where("n_chars > 0 AND fingerprint <> edited_fingerprint").collect()
    near, far = (np.array([r[c] for r in rows]) for c in ("near_edited", "near_next"))
    far = far[[r.near_next < 1 for r in rows]]
    assert np.mean(near[:, None] > far[None, :]) > 0.98


def plain_variants(docs, settings):
    counts = Counter()
    for name, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate({k: k + 32 for k in range(65, 91)})
            crc = zlib.crc32(f"{'' if name is None else name}:{run}".encode())
            if crc % settings.every == 0:
                at = crc % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= settings.least_chars and c >= settings.least_count}
    near, holes = defaultdict(set), defaultdict(set)
    for w in n:
        for k in range(len(w)):
            holes[w[:k] + "\0" + w[k + 1 :]].add(w)
            cut = w[:k] + w[k + 1 :]
            if cut in n:
                near[w].add(cut)
                near[cut].add(w)
    for group in holes.values():
        for w in group:
            near[w] |= group - {w}
    best = {w: min(x, key=lambda y: (-n[y], y)) for w, x in near.items() if x}
    form = {w: b for w, b in best.items() if n[b] >= settings.factor * n[w]}
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None))
    return sorted(out)


def variants(df, settings):
    return sorted(tuple(r) for r in spelling.spelling_variants(df, settings=settings).select("word", "form", "root", "n", "n_near", "form_n").collect())


@pytest.mark.parametrize("settings", [spelling.Settings(cell_words=50), spelling.Settings(least_chars=1, least_count=1, factor=2, every=7, cell_words=30), spelling.Settings(least_chars=3, least_count=1, cell_words=10_000)])
def test_variants_against_brute_force(spark, settings):
    random = np.random.default_rng(3)
    texts = []
    for k in range(40):
        words = ["".join(random.choice(list("abÀé"), random.integers(1, 9))) for _ in range(40)] + ["aaaaaa", "aaaaaaa", "AAAAAA", "abÀéab"] * 3
        texts.append((k, " ".join(words) + "."))
    texts += TEXTS
    assert variants(clashing(spark, texts), settings) == plain_variants(texts, settings)


def test_variants_of_repeated_letters_and_chains(spark):
    settings = spelling.Settings(least_chars=2, least_count=1, factor=5, every=10**9)
    words = {"aaab": 1, "aaaab": 5, "aaaaab": 25, "aaaaac": 25, "zzzz": 3, "zzz": 3, "é" * 300: 1, "é" * 301: 6}
    rows = {r.word: tuple(r) for r in spelling.variant_groups(spark.createDataFrame(list(words.items()), "word string, n long"), settings).collect()}
    assert rows["aaab"][1:] == ("aaaab", "aaaaab", 1, 1, 5)
    assert rows["aaaab"][1:] == ("aaaaab", "aaaaab", 5, 2, 25)
    assert rows["aaaaab"][1:] == (None, "aaaaab", 25, 2, None)
    assert rows["zzzz"][1:] == (None, "zzzz", 3, 1, None)
    assert rows["é" * 300][1] == "é" * 301
    assert spelling.spelling_variants(clashing(spark, []), settings=settings).count() == 0
    assert spelling.spelling_variants(clashing(spark, [(1, None), (2, "")])).count() == 0


def test_a_very_long_word(spark):
    word = "ab" * 50_000
    began = time.time()
    rows = spelling.variant_groups(spark.createDataFrame([(word, 1), (word + "c", 9)], "word string, n long")).collect()
    assert {(r.n, r.n_near, r.form_n) for r in rows} == {(1, 1, 9), (9, 1, None)} and time.time() - began < 120


def test_suffix_ranks_count_like_a_scan():
    random = np.random.default_rng(8)
    words = sorted({"".join(random.choice(list("abc"), random.integers(1, 7))) for _ in range(200)})
    index = spelling.SuffixRanks(words)
    for exact in (0, 1, 2):
        asked = [w for w in words if len(w) >= exact]
        pairs = set(zip(*(x.tolist() for x in index.one_error(asked, np.full(len(asked), exact))), strict=True))

        def near(a, b):
            if abs(len(a) - len(b)) > 1 or a == b:
                return False
            if len(a) == len(b):
                return sum(x != y for x, y in zip(a, b, strict=True)) == 1
            a, b = sorted((a, b), key=len)
            return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))

        want = {(i, j) for i, a in enumerate(asked) for j, b in enumerate(words) if near(a, b) and (not exact or b.endswith(a[-exact:]) and near(a[:-exact], b[:-exact]))}
        assert pairs == want


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate({k: k + 32 for k in range(65, 91)}))


def plain_search(docs, items, top=10):
    counted = [(name, Counter(terms(text))) for name, text in docs]
    sizes = [c.total() for _, c in counted]
    n_docs, length = sum(n > 0 for n in sizes), sum(sizes)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        scores = []
        for k, (name, c) in enumerate(counted):
            norm = 10 + 90 * sizes[k] * n_docs // length
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * norm)) for t in set(terms(text)) if t in c)
            if score > 0:
                scores.append((-score, name is None, name or 0, name))
        out += [(item, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scores)[:top], 1)]
    return sorted(out, key=str)


ITEMS = [(1, "three four HERE"), (1, "three four HERE"), (2, None), (3, "  "), (4, "nowhere found"), (None, "ünïted x7 Ünïted"), (6, "word1 word2 x5 one"), (7, "É")]


@pytest.mark.parametrize("settings", [ranked_search.Settings(), ranked_search.Settings(owners=1, part_queries=2), ranked_search.Settings(top=2, owners=9, block_postings=3)])
def test_search_of_odd_rows(spark, settings):
    docs, items = clashing(spark, TEXTS), spark.createDataFrame(ITEMS, "item_id long, text string").selectExpr("*", "'x' AS row", "'x' AS name", "'x' AS query")
    found = ranked_search.ranked_search(docs, items, settings=settings)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, found.collect()), key=str) == plain_search(TEXTS, ITEMS, settings.top)
    assert ranked_search.ranked_search(docs.limit(0), items, settings=settings).count() == 0
    assert ranked_search.ranked_search(docs, items.limit(0), settings=settings).count() == 0


@pytest.mark.parametrize("owners", [1, 3, 6])
def test_search_against_brute_force(spark, owners):
    random = np.random.default_rng(owners)
    common = random.zipf(1.3, size=20_000) % 400
    texts = [(int(k), " ".join(f"t{w}" for w in random.choice(common, random.integers(1, 60)))) for k in random.permutation(300)]
    texts += [(1000 + k, texts[0][1]) for k in range(30)]
    items = [(k, " ".join(f"t{w}" for w in random.choice(common, random.integers(1, 12)))) for k in range(25)]
    settings = ranked_search.Settings(owners=owners, block_postings=500, part_queries=7)
    found = ranked_search.ranked_search(spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), settings=settings)
    assert sorted(map(tuple, found.collect()), key=str) == plain_search(texts, items)
