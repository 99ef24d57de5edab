"""Periodic runs, the Merkle manifest, and repeated passages, against brute force."""

from __future__ import annotations

import random
import re
import zlib
from collections import defaultdict
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pubweave.llm import merkle, runs, spans, substrings
from pubweave.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string"


def words_of(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def hexed(text):
    return sha256(text.encode()).hexdigest()


# -- periodic runs


def plain_runs(words, least=12):
    """(start, period, length) of every run, trying every period."""
    number = {}
    coded = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    found = {}
    for q in range(1, len(words) // 2 + 1):
        same = np.concatenate([[0], (coded[:-q] == coded[q:]).astype(int), [0]])
        change = np.diff(same)
        for s, e in zip(np.flatnonzero(change == 1).tolist(), np.flatnonzero(change == -1).tolist(), strict=True):
            if e - s + q >= max(least, 2 * q):
                found.setdefault((s, e - s + q), q)
    return sorted((s, q, n) for (s, n), q in found.items())


def collapsed(words, found):
    gone = {i for s, q, n in found for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def periodic_text(rng):
    letters = [chr(97 + k) for k in range(rng.choice([1, 2, 3, 26]))]
    words = []
    for _ in range(rng.randint(0, 5)):
        unit = rng.choices(letters, k=rng.randint(1, 60))
        words += (unit * rng.randint(1, 8))[: rng.randint(1, 400)]
    return " ".join(words)


@pytest.mark.parametrize("least", [12, 5, 20])
def test_runs_agree_with_every_period_tried(rows, least):
    rng = random.Random(least)
    given = [(k if k % 40 else None, periodic_text(rng)) for k in range(150)]
    found = runs.collapse_runs(rows(given, DOCS).repartition(5), least).collect()
    assert len(found) == len(given) and sum(len(r.runs) for r in found) > 100
    for r in found:
        expected = plain_runs(words_of(r.text), least)
        assert [tuple(x) for x in r.runs] == expected
        assert r.cleaned.kept == collapsed(words_of(r.text), expected)


def test_a_long_text_of_long_periods(rows):
    rng = random.Random(4)
    unit = [f"w{rng.randrange(40)}" for _ in range(4000)]
    words = [*(unit * 3)[:11_111], "x", *unit[:3000], "y", *unit[:3000], *["la"] * 2000]
    found = runs.collapse_runs(rows([(1, " ".join(words))], DOCS)).first()
    assert [tuple(x) for x in found.runs] == plain_runs(words)


def test_runs_on_odd_rows(rows):
    twelve = " ".join("a" * 12)
    schema = "doc_id long, text string, runs int, cleaned string, `a.b` int, mark int, start int"
    given = [(1, None), (2, ""), (3, " \t\n"), (4, twelve), (4, twelve), (None, twelve), (5, "a " * 11), (4, "b " * 30)]
    found = runs.collapse_runs(rows([(*g, 7, "c", 8, 9, 10) for g in given], schema))
    assert found.columns == ["doc_id", "text", "runs", "cleaned", "a.b", "mark", "start", "runs_", "cleaned_"]
    by = sorted((r.doc_id or 0, [tuple(x) for x in r.runs_], r.cleaned_.kept, r.runs, r.start) for r in found.collect())
    one = [(0, 1, 12)]
    assert by == [
        (0, one, "a", 7, 10), (1, [], "", 7, 10), (2, [], "", 7, 10), (3, [], "", 7, 10), (4, one, "a", 7, 10),
        (4, one, "a", 7, 10), (4, [(0, 1, 30)], "b", 7, 10), (5, [], "a " * 10 + "a", 7, 10),
    ]
    assert runs.collapse_runs(rows([], DOCS)).count() == 0


def test_op11_on_the_given_documents(spark):
    found = {r.doc_id: r for r in QUERIES["op11_periodic_runs"](spark, SF_DIR).collect()}
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    assert len(found) == len(docs)
    changed = 0
    for d in docs:
        words = words_of(d.text)
        n, h = len(words), zlib.crc32(str(d.doc_id).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
            changed += 1
        expected = plain_runs(words)
        best = min(expected, key=lambda r: (-r[2], r[0], r[1]), default=(None, None, None))
        r = found[d.doc_id]
        assert (r.n_runs, r.start, r.period, r.length) == (len(expected), *best)
        assert r.exponent_milli == (None if best[0] is None else 1000 * best[2] // best[1])
        assert r.runs_sha256 == hexed("".join(f"{s},{n},{q}\n" for s, q, n in expected))
        assert r.collapsed_sha256 == hexed(collapsed(words, expected))
    assert changed > 5


def test_z_function_and_block_names():
    rng = random.Random(2)
    words = [rng.randrange(2) for _ in range(200)]
    for i, z in enumerate(runs.z_function(words)[1:], 1):
        assert words[:z] == words[i : i + z] and (i + z == 200 or words[z] != words[i + z])
    hashed = np.array([hash(w + 1) * 0x9E3779B97F4A7C15 % 2**64 for w in words], np.uint64)
    for block in (1, 3, 4, 16, 32):
        names = runs.block_names(hashed, block)
        by = defaultdict(set)
        for i in range(200 - block + 1):
            by[tuple(words[i : i + block])].add(int(names[i]))
        assert all(len(v) == 1 for v in by.values())
        assert len(set().union(*by.values())) == len(by)


# -- Merkle manifest


def plain_tree(leaves):
    """The root, and for each leaf the (left, right) of its way up."""
    level, paths, at = list(leaves), [[] for _ in leaves], list(range(len(leaves)))
    while len(level) > 1:
        for k, i in enumerate(at):
            run = level[i - i % 8 : i - i % 8 + 8]
            paths[k].append(("".join(run[: i % 8]), "".join(run[i % 8 + 1 :])))
        level = [hexed("".join(level[i : i + 8])) for i in range(0, len(level), 8)]
        at = [i // 8 for i in at]
    return level[0], paths


def plain_manifest(given):
    """By row number: subroot and path; and the root. Rows are (group, key, digest)."""
    groups = defaultdict(list)
    for k, (group, key, leaf) in enumerate(given):
        groups[(group is not None, (group or "").encode())].append(((key is not None, key or 0), leaf, k))
    subroots, found = [], {}
    for name in sorted(groups):
        members = sorted(groups[name])
        root, paths = plain_tree([m[1] for m in members])
        subroots.append(root)
        for member, path in zip(members, paths, strict=True):
            found[member[2]] = (root, path, len(subroots) - 1)
    root, over = plain_tree(subroots)
    return {k: (sub, path + over[at]) for k, (sub, path, at) in found.items()}, root


def checked(manifest, given):
    expected, root = plain_manifest([(g, k, leaf) for g, k, leaf, _ in given])
    assert manifest.root == root
    found = {r.n: r for r in manifest.proofs.select("*", F.col("path").alias("p")).collect()}
    assert len(found) == len(given)
    by_place = defaultdict(list)
    for k, (g, key, leaf, n) in enumerate(given):
        by_place[g, key, leaf].append((expected[k][0], expected[k][1]))
    for (g, key, leaf), wanted in by_place.items():
        own = [found[n] for a, b, c, n in given if (a, b, c) == (g, key, leaf)]
        assert sorted((r.subroot, [tuple(x) for x in r.path]) for r in own) == sorted(wanted)
        for r in own:
            held = leaf
            for left, right in r.path:
                held = hexed(left + held + right)
            assert held == root


@pytest.mark.parametrize("size", [1, 2, 8, 9, 64, 65, 700])
def test_manifest_agrees_with_a_plain_tree(rows, size):
    rng = random.Random(size)
    names = [None, "", "en", "É", "z"] + [f"l{k}" for k in range(7)]
    given = [
        (rng.choice(names[: 1 + size // 4]) if size < 60 or rng.random() < 0.5 else "en", rng.choice([None, k, 3]), hexed(str(k % 600)), k)
        for k in range(size)
    ]
    df = rows(given, "lang string, doc_id long, leaf string, n int").repartition(3)
    made = merkle.build(df, "leaf", "lang", "doc_id")
    checked(made, given)
    folds = made.proofs.select(merkle.folded(F.col("leaf"), F.col("path")).alias("root")).distinct().collect()
    assert [r.root for r in folds] == [made.root]


def test_manifest_of_odd_tables(rows):
    schema = "lang string, doc_id long, leaf string, subroot int, path int, tree int, `a.b` int, idx int"
    none = merkle.build(rows([], schema), "leaf", "lang", "doc_id")
    assert none.root is None and none.proofs.count() == 0
    same = [("en", 1, hexed("a"), 1, 2, 3, 4, 5)] * 20
    made = merkle.build(rows(same, schema), "leaf", "lang", "doc_id")
    assert made.proofs.columns == ["lang", "doc_id", "leaf", "subroot", "path", "tree", "a.b", "idx", "subroot_", "path_"]
    assert made.root == plain_tree([hexed("a")] * 20)[0] and made.proofs.count() == 20
    assert made.proofs.where("subroot = 1 and path = 2 and tree = 3 and idx = 5").count() == 20


def test_fields_read_apart(rows):
    df = rows([("ab", "c"), ("a", "bc"), (None, ""), ("", None), ("-", "é")], "a string, b string")
    found = [r[0] for r in df.select(merkle.row_digest([F.col("a"), F.col("b")])).collect()]
    assert len(set(found)) == 5 and found[2] == hexed("-0:") and found[4] == hexed("1:-2:é")


def test_tampered_rows_fail(spark):
    found = QUERIES["op12_merkle_manifest"](spark, SF_DIR).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    for r in found:
        hit = zlib.crc32(str(r.doc_id).encode()) % 3 == 0 and re.search("[A-Z]", texts[r.doc_id] or "")
        assert r.verified == (not hit) == (r.folded_root == r.root)


# -- repeated passages


def plain_repeats(given, width):
    """By (doc_id, text): words kept. Rows without an id come first, copies of a row are one."""
    order = sorted({(d, t, m) for d, t, m in given}, key=lambda r: (r[0] is not None, r[0] or 0, r[2]))
    seen, kept = set(), {}
    for d, t, _ in order:
        words, gone = words_of(t), set()
        for i in range(len(words) - width + 1):
            window = tuple(words[i : i + width])
            if window in seen:
                gone.update(range(i, i + width))
            seen.add(window)
        kept[d, t] = [w for i, w in enumerate(words) if i not in gone]
    return kept


@pytest.mark.parametrize("width", [1, 3, 20])
def test_repeats_agree_with_brute_force(rows, width, monkeypatch):
    monkeypatch.setattr(substrings, "CHUNK_BYTES", 3000)
    rng = random.Random(width)
    passages = [[f"w{rng.randrange(300)}" for _ in range(rng.randint(1, 60))] for _ in range(12)]
    given = []
    for k in range(120):
        words = []
        for _ in range(rng.randint(0, 4)):
            words += rng.choice(passages) if rng.random() < 0.5 else [f"w{rng.randrange(300)}" for _ in range(30)]
        given.append((None if k % 25 == 0 else k % 90, " ".join(words)))
    given += given[:10] + [(500, None), (501, ""), (502, " \n"), (503, " ".join(passages[0] * 100))]
    df = rows(given, DOCS).repartition(4)
    marked = [tuple(r) for r in spans.keyed(df).select("doc_id", "text", "mark").collect()]
    expected = plain_repeats(marked, width)
    found = substrings.drop_repeats(df, width).collect()
    assert len(found) == len(given)
    for r in found:
        kept = expected[r.doc_id, r.text]
        assert r.cleaned.kept == " ".join(kept)
        assert (r.cleaned.n_words, r.cleaned.n_removed) == (len(words_of(r.text)), len(words_of(r.text)) - len(kept))


def test_a_hot_passage_sends_one_row_a_chunk():
    text = " ".join(f"w{k}" for k in range(30))
    docs = pa.record_batch([pa.array([3, 1, 2, 1]), pa.array([0, 0, 0, 0]), pa.array([text] * 4)], ["doc_id", "mark", "text"])
    made = substrings.chunk_windows(docs, 20).to_pylist()
    windows = [r for r in made if r["first"] is None]
    assert len(windows) == 11 and {r["doc_id"] for r in windows} == {1}
    assert [(r["doc_id"], r["first"], r["last"]) for r in made if r["first"] is not None] == [(2, 0, 10), (3, 0, 10)]


def test_a_window_across_batches():
    names = ["window", "doc_id", "mark", "first", "last"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32()]
    rng = random.Random(3)
    given = [(rng.randrange(40) // 3, rng.choice([None, rng.randrange(9)]), rng.randrange(2), None, None) for _ in range(300)]
    given = sorted(given, key=lambda r: r[0])
    for k in range(0, 300, 50):
        given.insert(k, (99, 5, k, 1, 2))
    for size in (1, 2, 7, 400):
        parts = [given[i : i + size] for i in range(0, len(given), size)]
        made = [pa.record_batch([pa.array(v, k) for v, k in zip(zip(*p, strict=True), kinds, strict=True)], names) for p in parts]
        found = {tuple(r.values())[:3] for b in substrings.later(iter(made)) for r in b.to_pylist()}
        least = {}
        for w, d, m, f, _ in given:
            if f is None:
                least[w] = min(least.get(w, (True, 99, 0)), (d is not None, d or 0, m))
        expected = {(w, d, m) for w, d, m, f, _ in given if f or (d is not None, d or 0, m) != least[w]}
        assert found == expected


def test_repeats_on_odd_tables(rows):
    assert substrings.drop_repeats(rows([], DOCS)).count() == 0
    df = rows([(1, "a b", 1, 2, 3)], "doc_id long, text string, cleaned int, repeats int, `a.b` int")
    row = substrings.drop_repeats(df)
    assert row.columns == ["doc_id", "text", "cleaned", "repeats", "a.b", "cleaned_"]
    assert tuple(row.first().cleaned_) == (2, 0, "a b")
