import hashlib
import random
import re
import time
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from gamepulse.llm import hashing, language_id, maxent_lm, ngram_join
from gamepulse.llm.chat_format import format_chats
from gamepulse.llm.components import connected
from gamepulse.llm.decontaminate import Walks, contaminated, drop_contaminated, find, index_of
from gamepulse.llm.hashing import shingle_sets, word_hashes
from gamepulse.llm.hilbert_ann import hilbert_keys, nearest
from gamepulse.llm.language_id import identify, learn_prototypes
from gamepulse.llm.line_dedup import dedup_lines
from gamepulse.llm.maxent_lm import score_texts
from gamepulse.llm.ngram_join import jaccard_components
from gamepulse.llm.oracles import ORACLES
from gamepulse.llm.packing import WordTokens, pack, plan_patterns
from gamepulse.llm.quality import features, learn_quality, score_quality
from gamepulse.llm.queries import QUERIES, URL_RULES
from gamepulse.llm.url_filter import Rule, filter_urls, left_out

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
ODD = [None, "", " \t\n", "a", "one two three", "\n\n", "!!! ... 123", "É" * 50_000, "word " * 30_000]
SPACE = re.compile("[\x20\x09-\x0d]+")


def words(text):
    low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return [w for w in SPACE.split(low) if w]


def text_of(rng, n, vocabulary=3000):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    got = QUERIES[name](spark, sf_dir)
    want = con.execute(ORACLES[name])
    names = [c[0] for c in want.description]
    assert sorted(names) == sorted(got.columns)
    assert sorted(map(str, (tuple(r) for r in got.select(*names).collect()))) == sorted(map(str, want.fetchall()))


# ---- hashing and components

def test_hash_tables_do_not_grow_with_texts():
    """Hashes in stretches equal those of a plain polynomial, and a very long text leaves nothing behind."""
    spans = [b"ab", b"", b"x" * 1000, "é€".encode() * 300]
    data = np.frombuffer(b" ".join(spans), np.uint8)
    ends = np.cumsum([len(s) + 1 for s in spans]) - 1
    starts = ends - [len(s) for s in spans]
    whole = hashing.span_hashes(data, starts, ends)
    sums = [sum(int(hashing.BYTE_VALUES[b]) * pow(hashing._BASE, i, 1 << 64) for i, b in enumerate(s)) % (1 << 64) for s in spans]
    assert whole.tolist() == hashing.mix(np.array(sums, np.uint64)).tolist()
    long = b"y" * (3 * hashing.STRETCH + 7)
    assert hashing.span_hashes(np.frombuffer(long, np.uint8), np.array([0]), np.array([len(long)])) == hashing.mix(
        np.array([int(hashing.BYTE_VALUES[ord("y")]) * sum(pow(hashing._BASE, i, 1 << 64) for i in range(len(long))) % (1 << 64)], np.uint64))
    before = [t.nbytes for t in (hashing._POWERS, hashing._INVERSES)]
    shingle_sets(pa.array(["word " * 10_000_000]), 5)  # 50 MB
    assert [t.nbytes for t in (hashing._POWERS, hashing._INVERSES)] == before == [8 * hashing.STRETCH] * 2


def test_word_hashes_follow_words():
    texts = ODD[:-2] + ["A b", "a B c\x0bd", "x\u00a0y"]
    hashes, first = word_hashes(pa.array(texts, pa.string()))
    assert [b - a for a, b in zip(first[:-1], first[1:])] == [len(words(t)) for t in texts]
    known = {}
    for t, a in zip(texts, first[:-1]):
        for i, w in enumerate(words(t)):
            assert known.setdefault(w, hashes[a + i]) == hashes[a + i]
    assert len(set(known.values())) == len(known)


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 99), (99, 120), (120, 100), (7, 7)]
    got = {r["node"]: r["component"] for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 99: 99, 100: 99, 120: 99}
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0


# ---- 1: n-gram Jaccard join

def brute_components(rows, percent=75):
    sets = []
    for _, t in rows:
        w = words(t)
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            inter = len(sets[i] & sets[j])
            same = rows[i][0] is not None and rows[i][0] == rows[j][0]
            if rows[i][0] is None or rows[j][0] is None:
                continue
            if same or sets[i] and 100 * inter >= percent * (len(sets[i]) + len(sets[j]) - inter):
                a, b = label[i], label[j]
                label = [b if x == a else x for x in label]
    least = {x: min(rows[i][0] for i in range(len(rows)) if label[i] == x) for x in set(label) if all(rows[i][0] is not None for i in range(len(rows)) if label[i] == x)}
    return sorted(((r[0], len(s), least.get(x)) for r, s, x in zip(rows, sets, label)), key=str)


def near_rows(seed):
    rng = random.Random(seed)
    rows = [(i, t) for i, t in enumerate(ODD)]
    for group in range(6):
        base = text_of(rng, rng.choice([6, 20, 80, 300])).split()
        for _ in range(rng.choice([2, 12, 30])):
            own = list(base)
            for _ in range(rng.randrange(max(1, len(own) // 15) + 1)):
                own[rng.randrange(len(own))] = f"z{rng.randrange(9999)}"
            rows.append((len(rows), " ".join(own)))
    return rows + [(None, "one two three"), (5, "one two three"), (len(rows), rows[-1][1]), (len(rows), rows[-1][1])]


@pytest.mark.parametrize("options", [{}, {"unit_docs": 5, "few": 2, "hot": 3, "fragments": 3}])
def test_jaccard_equals_brute_force(docs, options):
    rows = near_rows(1)
    got = jaccard_components(docs(rows), **options)
    assert sorted((tuple(r) for r in got.select("doc_id", "n_shingles", "component_id").collect()), key=str) == brute_components(rows)


def test_jaccard_without_rows(docs):
    assert jaccard_components(docs([])).count() == 0
    assert jaccard_components(docs([(1, None)])).collect()[0]["component_id"] == 1


@pytest.mark.parametrize("percent", [20, 49, 75])
def test_large_groups_compare_all_widths(percent):
    rng = np.random.default_rng(4)
    grams = np.sort(rng.integers(0, 2 ** 63, 1300).astype(np.uint64))
    sets = [grams[:n] for n in (64, 65, 128, 129, 257, 260, 300, 513, 640, 700, 1025, 1300)]
    a, b = ngram_join.plausible(np.array([len(s) for s in sets]), [ngram_join.parities(s) for s in sets], percent)
    found = {(min(i, j), max(i, j)) for i, j in zip(a.tolist(), b.tolist())}
    assert {(i, j) for j in range(len(sets)) for i in range(j) if 100 * len(sets[i]) >= percent * len(sets[j])} <= found


def test_parities_never_rule_out_a_link():
    rng = np.random.default_rng(0)
    for n in (3, 60, 500, 5000):
        base = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        sets = [base]
        for share in (0.02, 0.05, 0.1, 0.14):
            drop = rng.random(len(base)) < share
            sets.append(np.unique(np.concatenate([base[~drop], rng.integers(0, 2**63, int(drop.sum())).astype(np.uint64)])))
        sizes, marks = np.array([len(s) for s in sets]), [ngram_join.parities(s) for s in sets]
        for k in (1, 3):
            a, b = ngram_join.plausible(np.tile(sizes, k), marks * k, 75)
            pairs = {(min(x, y), max(x, y)) for x, y in zip(a.tolist(), b.tolist())}
            for i in range(5 * k):
                for j in range(i):
                    inter = len(np.intersect1d(sets[i % 5], sets[j % 5]))
                    if 100 * inter >= 75 * (sizes[i % 5] + sizes[j % 5] - inter):
                        assert (j, i) in pairs
    sets = shingle_sets(pa.array([text_of(random.Random(i % 7), 200) for i in range(20)]), 5)
    both = ngram_join.overlaps(sets, [np.zeros(len(s), np.int64) for s in sets], 3)
    assert all(both[i, j] == len(np.intersect1d(sets[i], sets[j])) for i in range(20) for j in range(20) if i != j)


# ---- 2: language ID

def test_language_id_on_held_out(spark, sf_dir, table):
    got = QUERIES["op2_language_id"](spark, sf_dir).join(table("documents").select("doc_id", "lang"), "doc_id").filter("held_out").toPandas()
    assert (got.lang_pred == got.lang).mean() > 0.95 and got.score.between(0, 1).all()


def test_language_id_cases(docs):
    learnt = learn_prototypes(docs([(1, "the cat and the dog", "en"), (2, "der hund und die katze", "de"), (3, None, "fr")]))
    assert list(learnt) == ["de", "en"]
    rows = [(i, t) for i, t in enumerate([*ODD, "the dog", "DER HUND", "the dog"])] + [(None, "und die")]
    frame = docs(rows)
    got = {r["doc_id"]: r for r in identify(frame, learnt).collect()}
    assert set(frame.columns) <= set(got[0].asDict()) and len(got) == len(rows)
    assert [got[i]["lang_pred"] for i in (0, 1, 2, 5, 6)] == ["und"] * 5 and got[0]["score"] == 0
    assert [got[len(ODD) + i]["lang_pred"] for i in range(3)] == ["en", "de", "en"] and got[None]["lang_pred"] == "de"
    assert {r["lang_pred"] for r in identify(frame, {}).collect()} == {"und"}
    assert identify(docs([]), learnt).count() == 0


def test_runs_are_bound_and_bundled():
    found = language_id.LetterRuns(pa.array(["Ab c", "", "-", None, "жя"]))
    assert [b - a for a, b in found.spans] == [4, 0, 0, 0, 2]  # _ab ab_ b_c _c_, _жя жя_
    signs = lambda points: 1 - 2 * np.unpackbits(language_id.sign_bits(points, 128, 1).view(np.uint8), axis=1).astype(int)
    text = np.array([0, ord("a"), ord("b"), 0, ord("c"), 0])
    each = signs(text)
    want = sum(np.roll(each[i], 128) * np.roll(each[i + 1], 64) * each[i + 2] for i in range(4))
    assert (found.bundle(found.runs[:4], np.ones(4), 128, 1) == want).all()
    assert len({tuple(v) for v in signs(np.array([0x436, 0x44F, 0x4E2D, 0xE9, 0x61])).tolist()}) == 5  # every letter its own


def brute_language(train, texts, dimensions=512, seed=7):
    vector = {}

    def of(ch):
        if ch not in vector:
            vector[ch] = 1 - 2 * np.unpackbits(language_id.sign_bits(np.array([ord(ch) if ch != " " else 0]), dimensions, seed).view(np.uint8)).astype(int)
        return vector[ch]

    def bundle(text):
        s = " " + re.sub(" +", " ", "".join(c if c.isalpha() else " " for c in text.lower())).strip(" ") + " "
        return sum((np.roll(of(s[i]), 128) * np.roll(of(s[i + 1]), 64) * of(s[i + 2]) for i in range(len(s) - 2)), np.zeros(dimensions))

    learnt = {}
    for text, lang in train:
        learnt[lang] = learnt.get(lang, 0) + bundle(text)
    cosine = lambda a, b: a @ b / (np.linalg.norm(a) * np.linalg.norm(b))
    return [max(((cosine(v, bundle(t)), lang) for lang, v in sorted(learnt.items())), key=lambda x: x[0]) for t in texts]


def test_language_id_equals_brute_force(docs):
    train = [("the cat, and the dog", "en"), ("a dog in the house", "en"), ("der hund und die katze", "de"), ("кошка и собака", "ru"), ("ein haus", "de")]
    texts = ["the house", "das haus", "собака дома", "Katze!", "dog и die", "x"]
    got = {r["doc_id"]: r for r in identify(docs(list(enumerate(texts))), learn_prototypes(docs([(i, t, g) for i, (t, g) in enumerate(train)]))).collect()}
    for i, (score, lang) in enumerate(brute_language(train, texts)):
        assert got[i]["lang_pred"] == lang and abs(got[i]["score"] - max(score, 0)) < 1e-6


def test_many_labels_and_least_cosine(docs):
    rows = [(i, "the cat and the dog", "en") for i in range(5)] + [(9, "der hund", "de"), (10, "le chat", "fr")]
    assert list(learn_prototypes(docs(rows), max_langs=2)) == ["de", "en"]
    learnt = learn_prototypes(docs(rows[:5]))
    least = language_id.least_cosine(docs(rows[:5]), learnt)
    assert 0.4 < least <= 0.5 and language_id.least_cosine(docs([]), learnt) == 0 and language_id.least_cosine(docs(rows), {}) == 0


def test_least_cosine_sees_every_text(docs):
    """One rare far text in 200 is the quantile, whatever its hash; once only texts of small hashes were judged."""
    learnt = learn_prototypes(docs([(0, "the cat and the dog", "en")]))
    far = docs([(i, f"the c{'xyzvw'[i % 5]}{'bgjkq'[i // 5]}", "en") for i in range(25)])
    unseen = far.filter("pmod(xxhash64(text), 1 << 30) >= 0.9 * (1 << 30)").first()["text"]
    rows = docs([(i, unseen if i % 200 == 0 else "the cat and the dog", "en") for i in range(20_000)])
    own = identify(docs([(0, unseen, "en")]), learnt).first()["score"]
    assert own < 0.9 and language_id.least_cosine(rows, learnt) == own / 2
    assert language_id.least_cosine(identify(rows, learnt), learnt, judged=("lang_pred", "score")) == own / 2


# ---- 3: packing

def check_packing(rows, got, capacity):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    want = Counter()
    for doc, text in rows:
        want[doc, tuple(tokenizer.encode(text or "", add_special_tokens=False).ids + [1])] += 1
    by_doc = {}
    for r in got:
        by_doc.setdefault(r["doc_id"], []).append(r)
    for (doc, ids), n in want.items():
        mine = [r for r in by_doc[doc] if r["doc_tokens"] == len(ids)]
        cover = Counter()
        for r in mine:
            assert zlib.crc32(np.array(ids[r["start"]:r["start"] + r["length"]], "<u4").tobytes()) == r["ids_crc32"]
            cover.update(range(r["start"], r["start"] + r["length"]))
        assert cover == Counter({i: n for i in range(len(ids))})
    ends = {}
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends.get(r["sequence_id"], 0)
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert all(n == capacity or n < capacity and n & (n - 1) == 0 for n in ends.values())


def test_packing_round_trip(docs):
    rng = random.Random(3)
    rows = [(i, t) for i, t in enumerate(ODD[:7])] + [(100 + i, text_of(rng, rng.randrange(1, 60))) for i in range(150)] + [(None, "a b c"), (100, "x"), (8, "w " * 5000)]
    for capacity in (64, 2048):
        check_packing(rows, pack(docs(rows), TOKENIZER, capacity=capacity).collect(), capacity)
    assert pack(docs([]), TOKENIZER).count() == 0
    same = [(i, "the same text") for i in range(300)]
    check_packing(same, pack(docs(same), TOKENIZER, capacity=16).collect(), 16)


def test_patterns_fill_exactly():
    rng = np.random.default_rng(0)
    histogram = rng.integers(0, 40, 256)
    histogram[0] = 0
    used = np.zeros(256, int)
    for pattern, n in plan_patterns(histogram, 256, group=64):
        assert sum(k * v for k, v in pattern.items()) == 256 and n > 0
        for k, v in pattern.items():
            used[k] += v * n
    assert (used <= histogram).all() and used.sum() > 0.5 * histogram.sum()


def test_word_cache_equals_tokenizer():
    texts = [*ODD[:7], "don't stop,now.it's <|endoftext|> A<|EndOfText|>b<|endoftext|>,x", "é,É.x I'M é,a b\u3000c,d \x1c x..", "x\x85y, z", "<|startoftext|>,A <|", "1,000.5 a1,b2.c 'LL"]
    encoder = WordTokens(TOKENIZER, limit=10)
    for _ in range(2):
        ids, first = encoder.encode(pa.array(texts, pa.string()))
        for i, t in enumerate(texts):
            assert encoder.tokenizer.encode(t or "", add_special_tokens=False).ids == ids[first[i]:first[i + 1]].tolist()


# ---- 4: line dedup

def test_line_dedup_cases(docs):
    shared = "A shared line of text"
    rows = [(3, f"own three lines here\n  {shared.upper()} \nshort"), (1, f"{shared}\n{shared}"), (2, shared), (4, None), (5, ""), (None, shared), (2, shared), (6, "short\n\nshort")]
    got = {(r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in dedup_lines(docs(rows)).collect()}
    assert got == {
        (3, "own three lines here\nshort", 3, 1), (1, f"{shared}\n{shared}", 2, 0), (2, "", 1, 1), (4, "", 1, 0), (5, "", 1, 0),
        (None, shared, 1, 0), (6, "short\n\nshort", 3, 0)}
    assert dedup_lines(docs([])).count() == 0
    assert dedup_lines(docs(rows), min_docs=4).filter("n_dropped > 0").count() == 0


# ---- 5: URL filter

def brute_ratio(train, urls, order=4):
    from math import log10
    padded = lambda u: "\x02" * order + u + "\x03"
    counts = {True: {}, False: {}}
    for u, good in train:
        p = padded(u)
        for i in range(order, len(p)):
            for k in range(order + 1):
                counts[good].setdefault(p[i - k:i], Counter())[p[i]] += 1
    out = {}
    for u in urls:
        p, total = padded(u), 0.0
        for i in range(order, len(p)):
            probabilities = {}
            for good in (True, False):
                x = 1 / 256
                for k in range(order + 1):
                    c = counts[good].get(p[i - k:i])
                    if c:
                        x = (c[p[i]] + len(c) * x) / (sum(c.values()) + len(c))
                probabilities[good] = x
            total += log10(probabilities[True]) - log10(probabilities[False])
        out[u] = total / (len(p) - order)
    return out


def test_long_open_urls_take_linear_time(spark):
    """A URL of 200,000 characters that no rule decides, beside short ones."""
    urls = ["http://good.org/fr/a", "http://bad.net/x", "http://open.de/" + "ab/é" * 50_000, "http://open.de/\U0001F600x", None, ""]
    frame = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    begin = time.perf_counter()
    got = {r["page_id"]: r for r in filter_urls(frame, [Rule("allow", "org", "/"), Rule("block", "net", "/")], holdout=1 << 20).collect()}
    assert len(got) == len(urls) and time.perf_counter() - begin < 60
    want = brute_ratio([(urls[0], True), (urls[1], False)], [urls[3], ""])
    assert abs(got[3]["score"] - want[urls[3]]) < 1e-9 and abs(got[4]["score"] - want[""]) < 1e-9


def test_url_rules_and_ratio(spark, table):
    rng = random.Random(2)
    urls = [f"http://{rng.choice(['good', 'bad'])}{rng.choice('abc')}.{rng.choice(['org', 'net'])}/{rng.choice(['fr', 'xx'])}/{rng.choice('qwz') * 3}" for _ in range(120)]
    rules = [Rule("allow", "org", "/fr"), Rule("block", "net", "/xx/")]
    frame = spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate(urls)], "page_id long, url string, host string, rule string")
    got = {r["url"]: r for r in filter_urls(frame, rules).collect()}
    held = {r["u"] for r in spark.createDataFrame([(u,) for u in set(urls)], "u string").filter(left_out("u", 5)).collect()}
    judged = {u: got[u]["rule"] == "org/fr" for u in set(urls) if got[u]["rule"]}
    free = [u for u in set(urls) if not got[u]["rule"]]
    want = brute_ratio([(u, g) for u, g in judged.items() if u not in held], set(urls))
    assert free and all(abs(got[u]["score"] - want[u]) < 1e-9 for u in free)
    good, bad = ([want[u] for u, g in judged.items() if g == kind and u in held] for kind in (True, False))
    spread = np.std(good) + np.std(bad)
    cut = (np.mean(good) * np.std(bad) + np.mean(bad) * np.std(good)) / spread
    assert all(got[u]["verdict"] == ("allow" if want[u] >= cut else "block") for u in free if abs(want[u] - cut) > 1e-9)


def test_url_cases(spark):
    rows = [(1, None), (2, "no scheme"), (3, "HTTP://A.Example.NET/en/x?y"), (4, "http://net?/"), (5, "http://xnet/"), (6, "http://net/"), (7, "s://example.com/de/#a://b"), (6, "http://net/"), (None, ""), (8, "a://b.org/fr/" + "x" * 20_000)]
    got = filter_urls(spark.createDataFrame(rows, "page_id long, url string"), URL_RULES).collect()
    by = {r["page_id"]: r for r in got}
    assert len(got) == len(rows) and all(r["verdict"] in ("allow", "block") for r in got)
    assert (by[1]["host"], by[1]["path"], by[2]["host"]) == ("", "", "")
    assert (by[3]["host"], by[3]["path"], by[3]["rule"], by[3]["verdict"]) == ("a.example.net", "/en/x", "example.net/en/", "allow")
    assert by[4]["rule"] is None and by[5]["rule"] is None and by[6]["verdict"] == "block" and by[7]["rule"] == "example.com/de/"
    assert filter_urls(spark.createDataFrame([], "page_id long, url string"), URL_RULES).count() == 0


# ---- 6: language model

def test_lm_scores(spark, docs):
    rng = random.Random(4)
    rows = [(i, " ".join(f"{'ab'[i % 2]}{min(int(rng.expovariate(0.1)), 60)}" for _ in range(rng.randrange(5, 80)))) for i in range(200)]
    rows += [(1000 + i, t) for i, t in enumerate(ODD[:7])] + [(None, "a1 a2"), (0, rows[0][1])]
    got = score_texts(docs(rows), "doc_id % 10 = 0", max_frequent=50).collect()
    counts = Counter(w for d, t in rows if d is None or d % 10 for w in [*words(t), None])
    n, v = sum(counts.values()), len(counts)
    texts = {d: t for d, t in rows}
    assert len(got) == len(rows)
    for r in got:
        tokens = [*words(texts[r["doc_id"]]), None]
        base = sum(np.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens)
        assert abs(r["base_score"] - base) < 1e-6 * abs(base) + 1e-9 and r["train_tokens"] == n
        assert (r["n_tokens"], r["n_known"], r["held_out"]) == (len(tokens), sum(counts[w] > 0 for w in tokens), r["doc_id"] is not None and r["doc_id"] % 10 == 0)
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    assert score_texts(docs([]), "doc_id = 0").count() == 0
    assert score_texts(docs([(0, "a b")]), "doc_id = 0").first()["train_tokens"] == 0


def test_lm_layers_are_probabilities():
    rng = np.random.default_rng(0)
    w = maxent_lm.Weights(
        rng.normal(size=(maxent_lm.ROWS1, 32)).astype(np.float32), rng.normal(size=(maxent_lm.ROWS2, 32)).astype(np.float32), np.zeros(32, np.float32), np.zeros((32, 32), np.float32))
    everything = np.arange(maxent_lm.CELLS)
    total = np.exp(w.score(everything, np.full(1024, 7), np.full(1024, 900))).sum()
    assert abs(total - 1) < 1e-4


# ---- 7: decontamination

def edits(item, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item):
        new = [i + 1]
        for j, b in enumerate(text):
            new.append(min(row[j] + (a != b), row[j + 1] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_contamination_equals_brute_force(spark, docs):
    rng = random.Random(5)
    items = [(i, text_of(rng, n)) for i, n in enumerate([1, 3, 15, 30, 59, 200])] + [(50, None), (51, " \n"), (3, text_of(rng, 20))]
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, items[3][1].upper())]
    for k in range(60):
        item = items[2 + k % 4][1].split()
        for _ in range(k // 4 % 4):
            p = rng.randrange(len(item))
            item[p:p + rng.randrange(2)] = [f"q{k}"] * rng.randrange(2)
        rows.append((100 + k, f"{text_of(rng, rng.randrange(40))} {' '.join(item)} {text_of(rng, rng.randrange(40))}"))
    frame = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    found = {(r["doc_id"], r["item_id"], r["distance"]) for r in contaminated(docs(rows), frame).collect()}
    want = set()
    for d, t in rows:
        if len(words(t)) > 5000:
            continue
        for i in {i for i, _ in items}:
            best = [edits(words(x), words(t)) for j, x in items if j == i and words(x) and edits(words(x), words(t)) <= int(0.2 * len(words(x)))]
            want |= {(d, i, b) for b in best}
    exact = {w for w in want if w[2] == 0}
    assert exact <= found and found <= want and len(found) >= 0.95 * len(want)
    kept = {r["doc_id"] for r in drop_contaminated(docs(rows), frame).collect()}
    assert kept == {d for d, _ in rows} - {f[0] for f in found} and None not in kept
    few = contaminated(docs(rows), frame, block_chars=200)
    assert {(r["doc_id"], r["item_id"], r["distance"]) for r in few.collect()} >= exact
    empty = frame.filter("item_id < 0")
    assert contaminated(docs(rows), empty).count() == 0 and drop_contaminated(docs([]), frame).count() == 0
    assert drop_contaminated(docs(rows), empty).count() == len(rows)


def test_verbatim_items_are_found_at_every_offset():
    rng = random.Random(9)
    for n in [*range(1, 9), 13, 14, 15, 26, 27]:  # lengths on both sides of the window sizes
        items = [(i, text_of(rng, n, 10 ** 9)) for i in range(40)]
        texts = [f"{text_of(rng, before, 10 ** 9)} {t} {text_of(rng, after, 10 ** 9)}" for _, t in items for before in range(4) for after in (0, 30)]
        hits = find(index_of(items, Walks(), 0.2), pa.array(texts))
        assert all(hits.get((d, d // 8)) == (0, d % 8 // 2 + n) for d in range(len(texts))), n


def test_items_with_all_accepted_edits_are_found():
    rng = random.Random(13)
    for n in [5, 9, 10, 14, 15, 20, 25, 35, 60]:
        items = [(i, text_of(rng, n, 10 ** 9)) for i in range(60)]
        texts, want = [], []
        for k, (_, t) in enumerate(items):
            item = t.split()
            for _ in range(n // 5):
                p = rng.randrange(len(item))
                item[p:p + rng.randrange(2)] = [f"q{k}"] * rng.randrange(2)
            texts.append(f"{text_of(rng, rng.randrange(40), 10 ** 9)} {' '.join(item)} {text_of(rng, rng.randrange(40), 10 ** 9)}")
            want.append(edits(t.split(), texts[-1].split()))
        hits = find(index_of(items, Walks(), 0.2), pa.array(texts), complete=True)
        assert {k: d for k, (d, _) in hits.items()} == {(k, k): d for k, d in enumerate(want)}, n


@pytest.mark.parametrize("n", [5, 9, 10, 14, 15, 20, 25, 35, 60, 200])
def test_walks_alone_reach_the_target_recall(n):
    """Items with all the edits that are accepted, found by the keys of the walks and nothing else."""
    rng, found, tries = random.Random(n), 0, 60 if n == 200 else 400
    for part in range(0, tries, 20):
        items = [(i, text_of(rng, n, 10 ** 9)) for i in range(20)]
        texts = []
        for k, (_, t) in enumerate(items):
            item = t.split()
            for _ in range(n // 5):
                p = rng.randrange(len(item))
                item[p:p + rng.randrange(2)] = [f"q{k}"] * rng.randrange(2)
            texts.append(f"{text_of(rng, rng.randrange(40), 10 ** 9)} {' '.join(item)} {text_of(rng, rng.randrange(40), 10 ** 9)}")
        hits = find(index_of(items, Walks(), 0.2), pa.array(texts))
        assert all(d == i for d, i in hits)
        found += len(hits)
    assert found >= 0.97 * tries


def test_sampling_follows_from_the_target():
    for n in (5, 7, 10, 15, 20, 60, 400):
        for target in (0.9, 0.98, 0.999):
            walks = Walks(target, most_walks=64)
            s, run = walks.sampling(n, 0.2), -(-(n - n // 5) // (n // 5 + 1))
            assert walks.miss(run, s.width, s.visits, s.stride) ** s.walks <= 1 - target
    assert Walks().sampling(3, 0.2).walks == 1


# ---- 8: quality

def test_quality_separates_grades(spark, docs):
    rng = random.Random(6)
    text = lambda g: text_of(rng, rng.randrange(20, 60)) if g == 2 else (text_of(rng, 40).upper() + "!!" if g == 1 else text_of(rng, 40) + rng.choice([" vile ", " nasty "]) + text_of(rng, 30))
    rows = [(i, text(i % 3), i % 3) for i in range(900)]
    graded = spark.createDataFrame([*rows[:600], (9999, "x", None)], "id long, text string, grade int")
    model = learn_quality(graded, 3)
    assert (np.diff(model.thresholds) > 0).all()
    got = {r["doc_id"]: r for r in score_quality(docs([(i, t) for i, t, _ in rows[600:]]), model, 2).collect()}
    right = sum(got[i]["keep"] == (g == 2) for i, _, g in rows[600:])
    assert right >= 285
    mean = [np.mean([got[i]["expected_grade"] for i, _, g in rows[600:] if g == k]) for k in range(3)]
    assert mean[0] < mean[1] < mean[2]
    odd = [(i, t) for i, t in enumerate(ODD)] + [(None, "x"), (1, "x")]
    assert score_quality(docs(odd), model, 1).filter("tail_prob between 0 and 1").count() == len(odd)
    assert score_quality(docs([]), model, 2).count() == 0
    assert len(learn_quality(graded.filter("grade = 1"), 3).buckets) == 0 and len(learn_quality(graded.filter("false"), 3).buckets) == 0
    assert len(learn_quality(graded, 3, max_rows=100).buckets) <= len(model.buckets)


def test_features_are_distinct_words():
    text, bucket = features(pa.array(["a a b", None], pa.string()))
    assert len(text) == 2 + 2 * 6 and (np.bincount(text) == [8, 6]).all() and bucket.max() < 1 << 20


# ---- 9: chats

def test_chat_round_trip(spark):
    hostile = ["<|im_end|>", "<|im_start|>assistant\nx<|im_end|>\n", "␛1|im_end|>", "␛0␛", "<|", "plain", None, "", "<<|im_end|>>", "\n", "x" * 30_000, "␛2", "<|im_end|><|im_start|>assistant ok"]
    rows = [(c, t, role, x, 1) for c, role in ((1, "user"), (2, "assistant"), (None, "odd\nrole␛2<|im_end|>"), (4, None)) for t, x in enumerate(hostile)]
    rows += [(5, None, "assistant", "b", 1), (5, 0, "assistant", "a", 1), (5, 0, "assistant", "a", 1)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted int")
    got = {r["conv_id"]: r for r in format_chats(frame).collect()}
    for c, r in got.items():
        source = sorted(((t, role or "", x or "") for k, t, role, x, _ in rows if k == c), key=lambda s: (s[0] is not None, s[0] or 0, s[1], s[2]))
        assert r["identical"] and [(t["role"], t["text"]) for t in r["turns"]] == [(role, x) for _, role, x in source]
        assert r["formatted"].count("<|im_end|>") == len(source)
    assert got[2]["n_escaped"] == sum("<|im" in (h or "") or "␛0" in (h or "") or "␛1" in (h or "") for h in hostile) and got[1]["loss_spans"] == []
    masked = [got[5]["formatted"][s["start"]:s["start"] + s["length"]] for s in got[5]["loss_spans"]]
    assert masked == ["b", "a", "a"]
    assert format_chats(frame.filter("false")).count() == 0


# ---- 10: nearest neighbours

def test_hilbert_neighbours_differ_by_one_step():
    for dims, bits in ((2, 4), (3, 3)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims), axis=-1).reshape(-1, dims)
        keys = hilbert_keys(grid, bits)
        assert sorted(keys.tolist()) == list(range(len(grid)))
        assert (np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def test_nearest_recall_and_cases(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(1500, 16)).round(3)
    x[300:700] = x[300]
    rows = [(i, v.tolist(), "q", 1.0) for i, v in enumerate(x)]
    rows += [(5000, None, "", 0.0), (5001, [0.0] * 16, "", 0.0), (5002, [None] + [1.0] * 15, "", 0.0), (5020, [float("nan")] + [1.0] * 15, "", 0.0), (5040, [float("inf")] * 16, "", 0.0), (None, [1.0] * 16, "", 0.0), (5060, [1.0], "", 0.0), rows[7]]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rep string, score double")
    got = nearest(frame, "vec_id % 20 = 0", k=20, min_window=100, window_share=0.1, block_rows=64).toPandas()
    y = x.astype(np.float32).astype(np.float64)
    hit = 0
    for q in range(0, 1500, 20):
        own = got[got.query_id == q].sort_values("rank")
        scores = y @ y[q]
        scores[q] = -np.inf
        assert list(own["rank"]) == list(range(1, 21)) and np.allclose(own.score, scores[own.vec_id])
        assert [tuple(t) for t in own[["score", "vec_id"]].values] == sorted((tuple(t) for t in own[["score", "vec_id"]].values), key=lambda t: (-t[0], t[1]))
        hit += len(set(np.lexsort((np.arange(1500), -scores))[:20]) & set(own.vec_id))
    assert len(got) == 75 * 20 and hit >= 0.9 * len(got)
    dealt = nearest(frame, "vec_id % 20 = 0", k=20, min_window=100, window_share=0.1, block_rows=64, group_queries=3).toPandas()
    order = ["query_id", "rank"]
    assert dealt.sort_values(order).reset_index(drop=True).equals(got.sort_values(order).reset_index(drop=True))
    assert nearest(frame.filter("vec_id > 4999"), "true").count() == 0 and nearest(frame.filter("false"), "true").count() == 0
    assert nearest(frame.filter("vec_id < 3"), "vec_id = 0").count() == 2


# ---- pipeline

def test_pipeline_equals_brute_force(spark, docs, tmp_path):
    rng = random.Random(8)
    item = text_of(rng, 30)
    line = "one common line of text"
    rows = [(i, f"{text_of(rng, 40)}\n{line}") for i in range(8)]
    near = rows[2][1].split("\n")[0]
    rows += [(20, near + " extra"), (21, near), (22, f"{text_of(rng, 20)} {item} {text_of(rng, 5)}"), (23, None), (24, "123 !"), (25, ""), (None, text_of(rng, 12)), (3, rows[3][1])]
    folder = str(tmp_path / "in")
    docs(rows).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    frame, seen = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, frame, folder)
        assert out.columns == frame.columns and out.dtypes == frame.dtypes
        frame = spark.createDataFrame(out.collect(), out.schema)
        seen.append(sorted((str(r["doc_id"]) for r in frame.collect())))
    assert [len(s) for s in seen] == [13, 13, 11, 10]  # 21 is a line of 2, so it ends empty
    assert seen[-1] == sorted(["0", "1", "2", "3", "4", "5", "6", "7", "21", "None"])
    left = {r["doc_id"]: r["text"] for r in frame.collect()}
    assert [d for d, t in left.items() if line in t] == [0] and hashlib.sha256(left[0].encode()).hexdigest() == hashlib.sha256(rows[0][1].encode()).hexdigest()
    got = corpus_pipeline.run(spark, folder).collect()
    check_packing(list(left.items()), got, 2048)


def test_pipeline_keeps_different_texts_of_an_id(spark, docs):
    rng = random.Random(21)
    one, other, third = (text_of(rng, 40) for _ in range(3))
    rows = [(1, one), (1, other), (1, other + " extra"), (1, ""), (2, third), (2, one), (2, None), (3, ""), (3, " "), (None, other)]
    out = corpus_pipeline.ngram_jaccard(spark, docs(rows), "")
    got = sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str)
    assert got == sorted([(1, one), (1, other + " extra"), (2, third), (3, " "), (None, other)], key=str)
