"""Merkle manifest and importance resampling against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gamepulse.llm.importance import bucket_gains, crc_joined, resample, run_buckets
from gamepulse.llm.merkle import fold, leaf_digest, merkle_manifest, proof_digests

ODD = [None, "", " \t\n", "a", "one two three", "É" * 20_000, "word " * 30_000]
sha = lambda s: hashlib.sha256(s.encode()).hexdigest()


def brute_leaf(*values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def brute_tree(leaves, fan):
    """(root, proofs as lists of (left, right))."""
    proofs, where, level = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(level) > 1:
        for k, i in enumerate(where):
            run = level[i - i % fan:i - i % fan + fan]
            proofs[k].append(("".join(run[:i % fan]), "".join(run[i % fan + 1:])))
        level = [sha("".join(level[i:i + fan])) for i in range(0, len(level), fan)]
        where = [i // fan for i in where]
    return level[0], proofs


@pytest.mark.parametrize(("fan", "depth"), [(3, 1), (3, 2), (2, 3), (3, 6)])
def test_manifest_equals_brute_force(spark, fan, depth):
    rng = random.Random(depth)
    sources = [None, "", "a", "é", "z"] + ["hot"] * 8
    rows = [(i, rng.choice(sources), t) for i, t in enumerate(ODD)] + [(i, rng.choice(sources), f"text {i}\nline") for i in range(10, 90)]
    rows += [(None, "hot", "x"), (20, "hot", "again"), (20, "hot", "again"), (500, "alone", "x")]
    docs = spark.createDataFrame([(*r, "mine", 1) for r in rows], "doc_id long, source string, text string, leaf string, rank int").repartition(5)
    want, groups = [], {}
    for d, s, t in rows:
        groups.setdefault((s is not None, (s or "").encode()), []).append(((d is not None, d or 0), brute_leaf(d, s, t), d))
    trees = [(sorted(groups[g]), brute_tree([x[1] for x in sorted(groups[g])], fan)) for g in sorted(groups)]
    root, above = brute_tree([t[1][0] for t in trees], fan)
    for (members, (subroot, proofs)), top in zip(trees, above):
        want += [(m[2], m[1], subroot, root, p + top) for m, p in zip(members, proofs)]
    plain = merkle_manifest(docs, ["doc_id", "source", "text"], keep=[], fan=fan, depth=depth)
    found = [(r["doc_id"], r["leaf"], r["subroot"], r["root"], [(s["left"], s["right"]) for s in r["proof"]]) for r in plain.collect()]
    assert sorted(map(str, found)) == sorted(map(str, want))
    assert plain.select((fold(F.col("leaf"), F.col("proof")) == F.col("root")).alias("ok")).filter("not ok").count() == 0
    assert plain.filter(F.length(proof_digests(F.col("proof"))) % 64 != 0).count() == 0


def test_manifest_cases(spark):
    schema = "doc_id long, source string, text string"
    one = merkle_manifest(spark.createDataFrame([(1, None, None)], schema), ["doc_id", "text"]).collect()
    assert [(r["leaf"], r["subroot"], r["root"], r["proof"]) for r in one] == [(brute_leaf(1, None),) * 3 + ([],)]
    assert merkle_manifest(spark.createDataFrame([], schema), ["doc_id", "text"]).count() == 0
    changed = spark.createDataFrame([(i, "s", f"t{i}") for i in range(30)], schema).withColumn("other", leaf_digest(F.lit("x")))
    kept = merkle_manifest(changed, ["doc_id", "text"], keep=["other"], depth=2)
    assert kept.columns == ["doc_id", "other", "leaf", "subroot", "root", "proof"]
    assert kept.filter(fold(F.col("other"), F.col("proof")) == F.col("root")).count() == 0


def test_crc_of_joined_strings():
    parts = [b"", b"a", "é".encode() * 3, b"x" * 70_000, b" word"]
    pairs = [(a, b) for a in parts for b in parts]
    got = crc_joined(np.array([zlib.crc32(a) for a, _ in pairs]), np.array([zlib.crc32(b) for _, b in pairs], np.uint32), np.array([len(b) for _, b in pairs]))
    assert got.tolist() == [zlib.crc32(a + b) for a, b in pairs]


def brute_runs(text, longest):
    low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return words, [" ".join(words[i:i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


TEXTS = [*ODD, "A-b c'd É1 2", "\x00nul word", "same same same", "été ÉTÉ İ"]


@pytest.mark.parametrize("longest", [1, 2, 3])
def test_buckets_of_runs(longest):
    got, ends = run_buckets(pa.array(TEXTS, pa.string()), longest, 10_000)
    for text, a, b in zip(TEXTS, ends[:-1], ends[1:]):
        assert Counter(got[a:b].tolist()) == Counter(zlib.crc32(r.encode()) % 10_000 for r in brute_runs(text, longest)[1])
    assert len(run_buckets(pa.array([None, ""], pa.string()), longest, 10)[0]) == 0


def test_buckets_of_a_slice():
    """Blocks are slices of record batches; those without a null once gave other words."""
    texts = ["One two three", "Été B", "four FIVE", "C", "six"]
    for start in range(len(texts)):
        got, ends = run_buckets(pa.array(texts, pa.string()).slice(start, 2), 2, 10_000)
        for text, a, b in zip(texts[start:start + 2], ends[:-1], ends[1:]):
            assert sorted(got[a:b].tolist()) == sorted(zlib.crc32(r.encode()) % 10_000 for r in brute_runs(text, 2)[1])


def test_resampling_equals_brute_force(spark, docs):
    rng = random.Random(5)
    rows = list(enumerate(TEXTS)) + [(20 + i, " ".join(f"w{rng.randrange(60)}" for _ in range(rng.randrange(5, 60)))) for i in range(60)]
    rows += [(None, "w1 " * 30), (20, rows[len(TEXTS)][1]), (20, rows[len(TEXTS)][1])]
    target = ["w1 w2 w3 w1", None, "", "w5 w6 w5"]
    frame = spark.createDataFrame([(t, 1) for t in target], "text string, weight int")
    got = Counter(tuple(r) for r in resample(docs(rows), frame, buckets=64).collect())
    buckets = lambda t: [zlib.crc32(r.encode()) % 64 for r in brute_runs(t, 2)[1]]
    raw, wanted = Counter(b for _, t in rows for b in buckets(t)), Counter(b for t in target for b in buckets(t))
    gain = {b: math.floor(1000 * math.log((wanted[b] + 1) * (raw.total() + 64) / ((raw[b] + 1) * (wanted.total() + 64)))) for b in range(64)}
    assert bucket_gains(np.array([raw[b] for b in range(64)]), np.array([wanted[b] for b in range(64)])).tolist() == [gain[b] for b in range(64)]
    scored = []
    for d, t in rows:
        own = buckets(t)
        weight = sum(gain[b] for b in own) // len(own) if own else 0
        h = int(hashlib.sha256(f"7:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        scored.append((d, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(brute_runs(t, 2)[0])))
    long = sorted((s for s in scored if s[4] >= 20), key=lambda s: (-s[3], s[0] is not None, s[0] or 0))
    drawn = len(long) // 4
    want = Counter((*s[:4], k + 1 if k < drawn else None) for k, s in enumerate(long)) + Counter((*s[:4], None) for s in scored if s[4] < 20)
    assert drawn > 5 and got == want
    assert resample(docs([]), frame).count() == 0
    assert {r["rank"] for r in resample(docs(rows[:3]), spark.createDataFrame([], "text string")).collect()} == {None}
