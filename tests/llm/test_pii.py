"""Personal data: base patterns against plain regular expressions, the random field on held-out and disguised spans."""

import hashlib
import random
import re
import time

import numpy as np
import pytest

from gamepulse.llm import pii
from gamepulse.llm.pii import KINDS, SpanModel, all_spans, base_spans, candidates, disguised, find_pii, fit_spans, learn_spans, luhn, regions
from gamepulse.llm.queries import QUERIES

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    out = []
    for kind in KINDS:
        for m in re.finditer(PATTERNS[kind], text):
            d = re.sub("[^0-9]", "", m.group())
            ok = {"email": True, "ip": all(int(x) <= 255 for x in m.group().split(".")) if kind == "ip" else True, "card": 14 <= len(d) <= 19 and luhn(d), "phone": 10 <= len(d) <= 15}[kind]
            if ok:
                out.append((m.start(), m.end(), kind))
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def card(rng):
    body = [rng.randrange(10) for _ in range(15)]
    return next(s for k in range(10) if luhn(s := "".join(map(str, [*body, k]))))


def planted(rng):
    return {
        "email": f"{rng.choice(['ann', 'bo.li', 'c_d'])}.{rng.randrange(99)}@{rng.choice(['mail', 'post'])}{rng.randrange(9)}.example.{rng.choice(['com', 'org'])}",
        "ip": ".".join(str(rng.randrange(256)) for _ in range(4)), "card": card(rng), "phone": f"+1 ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}"}


def text_with(rng, spans):
    words = lambda: " ".join(rng.choice(["the", "of", "and", "house", "water", "ran", "é"]) for _ in range(rng.randrange(3, 9)))
    return words() + "".join(f" {s} {words()}" for s in spans)


@pytest.mark.parametrize("seed", range(4))
def test_base_equals_plain_patterns(seed):
    rng = random.Random(seed)
    for _ in range(4000):
        text = "".join(rng.choice(["a", "7", "12", ".", "@", "-", " ", "+", "(", ")", "é", "\n", "255", "256", "_", "4111111111111111"]) for _ in range(rng.randrange(30)))
        assert base_spans(text) == plain_spans(text), text


def test_long_texts_take_linear_time():
    begin = time.perf_counter()
    for text in ("a" * 400_000, "1" * 400_000, "1." * 200_000, "1 " * 200_000, "a@" * 200_000, "+1" * 200_000, "+1(" * 100_000, "1.2.3.a" * 60_000, "x at y dot " * 30_000):
        base_spans(text)
        assert all(b - a <= pii.PIECE + pii.MARGIN for a, b in regions(text))
    assert time.perf_counter() - begin < 20


@pytest.fixture(scope="module")
def model(spark):
    rng = random.Random(1)
    rows = [(i, text_with(rng, [planted(rng)[KINDS[i % 4]]] if i % 5 else [])) for i in range(240)]
    rows += [(900 + i, text_with(rng, [f"{rng.randrange(10**15, 10**16)}"])) for i in range(40)]
    return learn_spans(spark.createDataFrame(rows, "id long, text string"))


def test_model_finds_held_out_and_disguised_spans(model):
    rng = random.Random(77)
    caught = clean = 0
    for k in range(200):
        kind = KINDS[k % 4]
        span = planted(rng)[kind]
        text = text_with(rng, [span])
        caught += (text.index(span), text.index(span) + len(span), kind) in model.best(text, 1.0)
    assert caught >= 194
    for k in range(150):  # written so that no pattern fits
        kind = ["ip", "card", "phone"][k % 3]
        span = disguised(planted(rng)[kind], kind, rng)
        text = text_with(rng, [span])
        clean += any(y == kind and a <= text.index(span) + 2 and b >= text.index(span) + len(span) for a, b, y in all_spans(text, model, 1.0)[1])
    assert clean >= 130
    for text in ("4111 1111 1111 1112", "on 2024-01-15 10:22:33", "sum 1,234,567.89", "300.1.2.999", "token 740d10cfb38a379bfb9932", "meet at 10 dot", "plain words only"):
        assert all_spans(f"the house {text} of water", model, 1.0)[1] == []


def test_best_labelling_equals_search():
    rng = np.random.default_rng(0)
    text = "bo at mail dot ex dot org 4111 1111 1111 1111\n+1 555 123 4567 7"
    found = candidates(text)
    for _ in range(20):
        model = SpanModel(rng.normal(0, 0.4, (pii.N_FEATURES, 4)))
        scores = model.scores(found)
        gain = scores.max(axis=1) - 1.0
        best = {0: 0.0}  # best sum up to a character, over all segments
        for at in range(1, len(text) + 1):
            best[at] = max([best[at - 1], *(best[int(s)] + g for s, e, g in zip(found.start, found.end, gain) if e == at)])
        chosen = model.best(text, 1.0)
        where = {(int(a), int(b)): k for k, (a, b) in enumerate(zip(found.start, found.end))}
        assert abs(sum(gain[where[a, b]] for a, b, _ in chosen) - best[len(text)]) < 1e-9
        assert all(KINDS[int(scores[where[a, b]].argmax())] == kind for a, b, kind in chosen)
        assert all(x[1] <= y[0] for x, y in zip(chosen, chosen[1:]))


def test_training_raises_the_likelihood():
    lines, gold = ["pay 4111111111111111 now", "num 4111111111111112 now"], [[(4, 20, "card")], []]

    def likelihood(model):
        total = 0.0
        for line, spans in zip(lines, gold):
            found = candidates(line)
            scores = model.scores(found)
            ahead = [0.0] + [-np.inf] * int(found.last.max())
            for t in range(1, len(ahead)):
                ends = np.flatnonzero(found.last == t)
                ahead[t] = np.logaddexp.reduce([ahead[t - 1], *(ahead[found.first[s]] + x for s in ends for x in scores[s])])
            own = sum(scores[np.flatnonzero((found.start == a) & (found.end == b))[0], KINDS.index(k)] for a, b, k in spans)
            total += own - ahead[-1]
        return total

    steps = [likelihood(fit_spans(lines, gold, steps=n)) for n in (0, 5, 20, 80)]
    assert steps == sorted(steps) and steps[-1] > -0.1 and not fit_spans(["1234567"], [[]]).weights.any()


def test_cases(docs, model):
    rows = [(1, None), (2, ""), (3, "a@b.co, +1 (212) 555-0101\n10.0.0.1 é 4111 1111 1111 1111"), (None, "x@y.z"), (3, "a@b.co"), (4, "x " * 50_000 + "q@w.e")]
    got = find_pii(docs(rows), model)
    assert got.columns == ["doc_id", "base", "spans"]
    found = sorted(((r["doc_id"], [(s["start"], s["end"], s["kind"]) for s in r["base"]]) for r in got.collect()), key=str)
    assert found == sorted([(d, base_spans(t or "")) for d, t in rows], key=str)
    assert all(set(map(tuple, r["base"])) <= set(map(tuple, r["spans"])) for r in got.collect())
    assert find_pii(docs([]), model).count() == 0 and not learn_spans(docs([])).weights.any()


def test_query(spark, sf_dir, table):
    texts = {r["doc_id"]: r["text"] for r in table("documents").collect()}
    got = QUERIES["op12_pii"](spark, sf_dir).collect()
    assert len(got) == len(texts)
    for r in got:
        base = plain_spans(texts[r["doc_id"]] or "")
        assert [r[f"n_{k}"] for k in KINDS] == [sum(s[2] == k for s in base) for k in KINDS]
        told = [f"{k}:{a}:{b}" for a, b, k in base]
        assert r["base_sha256"] == hashlib.sha256(",".join(told).encode()).hexdigest() and set(told) <= set(filter(None, r["spans"].split(",")))
