"""Personal data by fixed patterns and a semi-Markov conditional random field.

The patterns are the base and always stand. The random field adds what they miss: it looks at the tokens
around digits and at-signs, scores every candidate segment of bounded length by features of the whole span
(digits, check sum, groups, separators, what stands before and after), and a dynamic program over the
segments chooses boundaries and kinds together. It is trained on a bounded sample of documents: base spans,
also rewritten in the ways people disguise them, against everything around them and near misses.
"""

from __future__ import annotations

import random
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gamepulse.llm.common import blocks, small_batches

KINDS = ["email", "ip", "card", "phone"]
Span = tuple[int, int, str]

# ---- base patterns, in time linear in the text

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_NUMBERS = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = int(d) * (1 + k % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    begin = 0  # where the part before the next @ may start
    at = text.find("@")
    while at >= 0:
        local = len(text[begin:at]) - len(text[begin:at].rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1) if local else None
        if domain:
            yield at - local, domain.end(), "email"
        begin = domain.end() if domain else at + 1
        at = text.find("@", begin)


def _addresses(text: str) -> Iterator[Span]:
    for m in _NUMBERS.finditer(text):
        if m.group().count(".") < 3:
            continue
        parts, at = m.group().split("."), m.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k:k + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                yield at, end, "ip"
            at = end + 1


def _digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def base_spans(text: str) -> list[Span]:
    """(start, end, kind) by start, then kind; leftmost matches that do not overlap within a kind."""
    out = list(_emails(text))
    out += _addresses(text)
    out += [(m.start(), m.end(), "card") for m in _CARD.finditer(text) if m.end() - m.start() >= 14 and 14 <= len(d := _digits(m.group())) <= 19 and luhn(d)]
    out += [(m.start(), m.end(), "phone") for m in _PHONE.finditer(text) if 10 <= len(_digits(m.group())) <= 15]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


# ---- regions: where a candidate can be

_DIGITS = re.compile(r"[0-9](?:[^A-Za-z0-9\n]{0,3}+[0-9]){6,}+")
_AT_WORD = re.compile(r"(?<![A-Za-z0-9])[aA][tT](?![A-Za-z0-9])(?=[^\n]{1,40}(?<![A-Za-z0-9])[dD][oO][tT](?![A-Za-z0-9]))")
MARGIN = 64  # characters to each side of a trigger
MAX_TOKENS, MAX_CHARS = 24, 200  # longest candidate
PIECE = 1 << 16  # characters of one region that are looked at together


def regions(text: str) -> list[tuple[int, int]]:
    """Runs of one line around digits, at-signs and spelt-out addresses; a long one in pieces of about PIECE."""
    marks = [(m.start(), m.end()) for m in _DIGITS.finditer(text)]
    at = text.find("@")
    while at >= 0:
        marks.append((at, at + 1))
        at = text.find("@", at + 1)
    if "dot" in text or "DOT" in text or "Dot" in text:
        marks += [(m.start(), m.end()) for m in _AT_WORD.finditer(text)]
    out: list[list[int]] = []
    for a, b in sorted(marks):
        low = max(text.rfind("\n", max(a - MARGIN, 0), a) + 1, a - MARGIN, 0)
        stop = text.find("\n", b, b + MARGIN)
        high = min(b + MARGIN, len(text)) if stop < 0 else stop
        if out and low <= out[-1][1] and high - out[-1][0] <= PIECE:
            out[-1][1] = max(out[-1][1], high)
        else:
            for k in range(low, high, PIECE - MAX_CHARS - MARGIN):  # pieces overlap by the longest candidate
                out.append([k, min(k + PIECE, high)])
                if k + PIECE >= high:
                    break
    return [(a, b) for a, b in out]


# ---- tokens and features

DIGIT, LETTER, SPACE, LINE, DOT, DASH, ROUND, SQUARE, PLUS, AT, LOCAL_MARK, OTHER = range(12)
_KIND = np.full(128, OTHER, np.int8)
for _chars, _kind in [
    ("0123456789", DIGIT), ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", LETTER), (" \t", SPACE), ("\n", LINE), (".", DOT), ("-", DASH), ("()", ROUND),
    ("[]", SQUARE), ("+", PLUS), ("@", AT), ("_%", LOCAL_MARK),
]:
    _KIND[[ord(c) for c in _chars]] = _kind


@dataclass
class Candidates:
    """Segments of a run of lines: character bounds, first and last token, feature numbers (one per template)."""

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    last: np.ndarray
    features: np.ndarray


def _slots(*values: tuple[np.ndarray, int]) -> np.ndarray:
    """One column of numbers per template, each template with its own range of numbers."""
    base = np.cumsum([0, *[n for _, n in values]])[:-1]
    return np.stack([np.minimum(v, n - 1) + b for (v, n), b in zip(values, base)], axis=1).astype(np.int32)


_DIGIT_BINS = np.array([0, 1, 1, 1, 2, 2, 2, 3, 3, 3, 4, 5, 6, 7, 8, 8, 9, 10, 10, 10, 11])
_GROUP_BINS = np.array([0, 1, 1, 1, 2, 3, 3, 3, 4, 4, 4, 4, 4, 5])
_LENGTH_BINS = np.array([0, 0, 1, 1, 2, 2, 3, 3, 4, 4, 4, 5, 5, 5, 6, 6, 6, 6, 7, 7, 7, 7, 7, 7, 7])
N_FEATURES = 12 + 3 + 8 + 6 + 3 + 12 + 12 + 9 + 15 + 6 + 5 + 5 + 12 + 12 + 13 + 13 + 8 + 24 + 2 + 2 + 5 + 6 + 6


def candidates(text: str) -> Candidates:
    """All segments of at most MAX_TOKENS tokens, on a line and not glued to a letter or digit, that can be one of KINDS.

    They hold one at (sign or word) and a dot, or seven digits and no word but "dot".
    """
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = np.where(points < 128, _KIND[np.minimum(points, 127)], LETTER)
    new = np.ones(len(points), bool)
    new[1:] = (kinds[1:] != kinds[:-1]) | (kinds[1:] >= LINE)
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], len(points))
    kind, size, n = kinds[starts], ends - starts, len(starts)
    if not n:
        return Candidates(*[np.zeros(0, np.int64)] * 4, np.zeros((0, 23), np.int32))
    lower = lambda k, c: (points[np.minimum(starts + k, len(points) - 1)] | 32) == ord(c)
    word = kind == LETTER
    at_word = word & (size == 2) & lower(0, "a") & lower(1, "t")
    dot_word = word & (size == 3) & lower(0, "d") & lower(1, "o") & lower(2, "t")
    digit = kind == DIGIT
    value = np.zeros(n, np.int64)
    for k in range(3):
        value = np.where(digit & (size > k), value * 10 + points[np.minimum(starts + k, len(points) - 1)].astype(np.int64) - 48, value)
    octet = digit & (size <= 3) & (value <= 255)
    summed = lambda x: np.concatenate([[0], np.cumsum(x, dtype=np.int64)])
    count = {k: summed(kind == k) for k in (DIGIT, LETTER, SPACE, LINE, DOT, DASH, ROUND, SQUARE, PLUS, AT)}
    digits, at_words, dot_words, octets = summed(np.where(digit, size, 0)), summed(at_word), summed(dot_word), summed(octet)
    others, marks = summed((kind == OTHER) | (kind == LOCAL_MARK)), summed(kind == LOCAL_MARK)
    # check sums from running sums over all digits: as they are and doubled, at even and odd places
    figure = points[kinds == DIGIT].astype(np.int64) - 48
    double = np.where(figure > 4, 2 * figure - 9, 2 * figure)
    even = np.arange(len(figure)) % 2 == 0
    single_even, single_odd, double_even, double_odd = (summed(np.where(m, v, 0)) for v in (figure, double) for m in (even, ~even))

    solid = np.isin(kind, (DIGIT, LETTER))
    glued = np.concatenate([[False], solid[1:] & solid[:-1], [False]])  # to the token before
    opens = ~glued[:-1] & (solid | (kind == PLUS) | (kind == ROUND))
    closes = solid & ~glued[1:]
    ats, dots, words = (summed(x) for x in ((kind == AT) | at_word, (kind == DOT) | dot_word, word & ~dot_word))
    groups = np.where(digit, size, 0)
    rows, largest = [], np.zeros(n, np.int64)
    for length in range(1, min(MAX_TOKENS, n) + 1):
        i = np.arange(n - length + 1)
        j = i + length
        largest = np.maximum(largest[:len(i)], groups[length - 1:])
        ok = opens[i] & closes[j - 1] & (count[LINE][j] == count[LINE][i]) & (ends[j - 1] - starts[i] <= MAX_CHARS)
        ok &= np.where(ats[j] == ats[i], (digits[j] - digits[i] >= 7) & (words[j] == words[i]), (ats[j] - ats[i] == 1) & (dots[j] > dots[i]) & solid[i])
        keep = np.flatnonzero(ok)
        rows.append(np.stack([i[keep], j[keep], largest[keep]]))
    i, j, most = np.concatenate(rows, axis=1)
    of = lambda s: s[j] - s[i]
    n_digits, n_groups = of(digits), of(count[DIGIT])
    odd_last = (digits[j] - 1) % 2 == 1
    a, b = digits[i], digits[j]
    checks = np.where(odd_last, single_odd[b] - single_odd[a] + double_even[b] - double_even[a], single_even[b] - single_even[a] + double_odd[b] - double_odd[a])
    card_size = (n_digits >= 13) & (n_digits <= 19)
    around = np.concatenate([[LINE], kind, [LINE]])
    n_at, n_dot = of(count[AT]), of(count[DOT])
    n_at_word, n_dot_word, n_letters = of(at_words), of(dot_words), of(count[LETTER])
    four = (n_groups == 4) & (of(octets) == 4) & (n_dot + n_dot_word == 3) & (n_letters == n_dot_word)
    mail = (n_at + n_at_word == 1) & (n_dot + n_dot_word >= 1) & (n_letters - n_at_word - n_dot_word >= 2)
    bins = lambda table, x: table[np.minimum(x, len(table) - 1)]
    plus = (kind[i] == PLUS).astype(int)
    runs = summed(solid & ~glued[:-1] & ~at_word & ~dot_word)
    joints = of(ats) + of(dots) + of(count[DASH]) + of(count[PLUS]) + of(marks)
    side = np.select([(kind == DOT) | dot_word, (kind == AT) | at_word, word, digit, (kind == ROUND) | (kind == SQUARE)], [1, 2, 3, 4, 5], 0)
    side = np.concatenate([[0, 0], side, [0, 0]])  # of the nearest token that is no space, before and after
    before = side[np.where(around[i] == SPACE, i, i + 1)]
    after = side[np.where(around[j + 1] == SPACE, j + 3, j + 2)]
    features = _slots(
        (bins(_DIGIT_BINS, n_digits), 12), (np.where(card_size, 1 + (checks % 10 > 0), 0), 3), (n_groups, 8), (bins(_GROUP_BINS, most), 6),
        (np.where(n_groups == 0, 0, 1 + (of(octets) < n_groups)), 3), (kind[i], 12), (kind[j - 1], 12),
        (np.minimum(n_at, 2) * 3 + np.minimum(n_at_word, 2), 9), (np.minimum(n_dot, 4) * 3 + np.minimum(n_dot_word, 2), 15),
        (np.where(n_letters > 3, 4 + (n_letters > 6), n_letters), 6), (of(count[SPACE]), 5), (of(count[DASH]), 5),
        (np.minimum((of(count[ROUND]) + 1) // 2, 2) * 4 + np.minimum((of(count[SQUARE]) + 1) // 2, 3), 12),
        (np.minimum(of(count[PLUS]), 2) * 4 + np.minimum(of(others), 3), 12), (around[i] + 0, 13), (around[j + 1] + 0, 13), (_LENGTH_BINS[j - i], 8),
        (bins(_DIGIT_BINS, n_digits) * 2 + plus, 24), (four.astype(int), 2), (mail.astype(int), 2),
        (np.clip(runs[j] - runs[i] - joints + 1, 0, 4), 5), (before, 6), (after, 6))
    return Candidates(starts[i], ends[j - 1], i, j, features)


# ---- the model

@dataclass
class SpanModel:
    """A weight per feature and kind; a token outside all spans scores 0."""

    weights: np.ndarray

    def scores(self, found: Candidates) -> np.ndarray:
        out = np.zeros((len(found.start), len(KINDS)))
        for column in found.features.T:
            out += self.weights[column]
        return out

    def best(self, text: str, caution: float) -> list[Span]:
        """The segments of the best labelling of the lines, by dynamic program; each pays `caution`."""
        found = candidates(text)
        scores = self.scores(found)
        kind = scores.argmax(axis=1)
        gain = scores[np.arange(len(kind)), kind] - caution
        use = np.flatnonzero(gain > 0)  # no other segment is better than the tokens by themselves
        use = use[np.lexsort((found.start[use], found.end[use]))]
        stops = found.end[use].tolist()
        value, taken = [0.0], [(-1, -1)]  # best of the first k segments by end; (segment, before)
        for k, s in enumerate(use.tolist()):
            before = int(np.searchsorted(stops[:k], found.start[s], side="right"))
            with_it = value[before] + gain[s]
            value.append(max(value[-1], with_it))
            taken.append((s, before) if with_it > value[-2] else (-1, k))
        out, k = [], len(use)
        while k:
            s, before = taken[k]
            if s >= 0:
                out.append((int(found.start[s]), int(found.end[s]), KINDS[kind[s]]))
            k = before
        return out[::-1]


def fit_spans(lines: list[str], gold: list[list[Span]], steps: int = 120, ridge: float = 0.002) -> SpanModel:
    """Maximum likelihood of the gold spans of each line, by forward and backward sums over all segmentations."""
    weights = np.zeros((N_FEATURES, len(KINDS)))
    found = [candidates(x) for x in lines]
    kept = []
    for k, (c, spans) in enumerate(zip(found, gold)):
        where = {(a, b): s for s, (a, b) in enumerate(zip(c.start.tolist(), c.end.tolist()))}
        if len(c.start) and all((a, b) in where for a, b, _ in spans):
            kept.append((k, [(where[a, b], KINDS.index(y)) for a, b, y in spans]))
    if not any(spans for _, spans in kept):
        return SpanModel(weights)
    line = np.concatenate([np.full(len(found[k].start), r) for r, (k, _) in enumerate(kept)])
    first, last = (np.concatenate([getattr(found[k], name) for k, _ in kept]) for name in ("first", "last"))
    features = np.concatenate([found[k].features for k, _ in kept])
    base = np.cumsum([0, *[len(found[k].start) for k, _ in kept]])
    target = np.zeros((len(line), len(KINDS)))
    for r, (_, spans) in enumerate(kept):
        for s, y in spans:
            target[base[r] + s, y] = 1
    width, n_lines = int(last.max()) + 1, len(kept)
    by_end, by_start = [np.flatnonzero(last == t) for t in range(width)], [np.flatnonzero(first == t) for t in range(width)]
    mean, square = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, steps + 1):
        scores = np.zeros((len(line), len(KINDS)))
        for column in features.T:
            scores += weights[column]
        whole = np.logaddexp.reduce(scores, axis=1)
        ahead, behind = np.zeros((n_lines, width)), np.zeros((n_lines, width))
        for t in range(1, width):
            ahead[:, t] = ahead[:, t - 1]
            s = by_end[t]
            np.logaddexp.at(ahead[:, t], line[s], ahead[line[s], first[s]] + whole[s])
        for t in range(width - 2, -1, -1):
            behind[:, t] = behind[:, t + 1]
            s = by_start[t]
            np.logaddexp.at(behind[:, t], line[s], behind[line[s], last[s]] + whole[s])
        total = ahead[:, -1]
        share = np.exp(ahead[line, first] + behind[line, last] - total[line])[:, None] * np.exp(scores)
        slope = np.zeros_like(weights)
        off = target - share
        felt = np.flatnonzero(np.abs(off).max(axis=1) > 1e-7)  # the others change nothing that can be measured
        for y in range(len(KINDS)):
            for column in features[felt].T:
                slope[:, y] += np.bincount(column, off[felt, y], minlength=N_FEATURES)
        slope = slope / n_lines - ridge * weights / np.sqrt(n_lines)
        mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope * slope
        weights += 0.1 * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.99 ** step)) + 1e-8)
    return SpanModel(weights)


# ---- training data

def disguised(span: str, kind: str, rng: random.Random) -> str:
    """A span as people write it to evade patterns, or in another common form."""
    if kind == "email":
        local, domain = span.split("@")
        if rng.random() < 0.5:
            local = re.sub("[0-9]", lambda m: "abcdefghij"[int(m.group())], local)
        labels = domain.split(".")
        if len(labels) > 2 and rng.random() < 0.5:
            labels = labels[1:]
        span = f"{local}@{'.'.join(labels)}"
        at, dot = rng.choice([(" at ", " dot "), ("(at)", "(dot)"), ("[at]", "[dot]"), (" (at) ", " (dot) "), (" [at] ", " [dot] "), (" @ ", " . "), (" AT ", " DOT ")])
        return span.replace("@", at).replace(".", dot)
    if kind == "ip":
        return span.replace(".", rng.choice(["[.]", "(.)", " . ", " dot "]))
    digits = _digits(span)
    if kind == "card":
        gap = rng.choice([".", " - ", "  ", "-", " "])
        return gap.join(digits[k:k + 4] for k in range(0, len(digits), 4))
    area, middle, end = digits[-10:-7], digits[-7:-4], digits[-4:]
    return rng.choice([f"({area}) {middle}-{end}", f"({area}){middle}-{end}", f"+{digits[:-10] or 1}/{area}/{middle}{end}", f"+{digits[:-10] or 1} {area} / {middle} {end}"])


def spoilt(span: str, kind: str, rng: random.Random) -> str:
    """A near miss of a span: a wrong check sum, an octet too large, no domain, too few digits."""
    if kind == "email":
        return rng.choice([span.split("@")[0] + "@", "@" + span.split("@")[0], span.split("@")[0] + " at home"])
    if kind == "ip":
        return rng.choice([span + ".7", span.replace(".", ".9", 1) + "99.4", f"1{span.replace('.', '')[:6]}.25"])
    if kind == "card":
        k = rng.randrange(len(span))
        wrong = span[:k] + (str((int(span[k]) + 1) % 10) if span[k].isdigit() else span[k]) + span[k + 1:]
        d = _digits(wrong)
        return wrong if not luhn(d) else span[:-1]
    d = _digits(span)
    return rng.choice([d[:8], f"20{d[-2:]}-0{int(d[-3]) % 9 + 1}-1{d[-1]} 1{d[-4]}:{d[-2:]}:00", f"{d[:3]},{d[3:6]},{d[6:9]}.{d[-2:]}"])


def _training_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(line, starts, ends, kinds) of every region that is one line short enough to train on."""
    for block in blocks(batches, "text", 4 << 20):
        out: list[tuple] = []
        for text in block.column("text").to_pylist():
            spans = base_spans(text) if text else []
            for a, b in regions(text) if text else []:
                own = [s for s in spans if s[0] < b and s[1] > a]
                clear = all(x[1] <= y[0] for x, y in zip(own, own[1:])) and all(s[0] >= a and s[1] <= b for s in own)
                if b - a <= 400 and clear:
                    out.append((text[a:b], [s[0] - a for s in own], [s[1] - a for s in own], [s[2] for s in own]))
        cols = list(zip(*out)) if out else [[]] * 4
        yield pa.RecordBatch.from_arrays([
            pa.array(cols[0], pa.string()), pa.array(cols[1], pa.list_(pa.int32())), pa.array(cols[2], pa.list_(pa.int32())),
            pa.array(cols[3], pa.list_(pa.string()))], names=["line", "starts", "ends", "kinds"])


def learn_spans(docs: DataFrame, text_col: str = "text", max_docs: int = 50_000, max_lines: int = 100, seed: int = 5) -> SpanModel:
    """Trains on the base spans of about `max_docs` documents, those with the smallest hash of their text.

    Of these, at most `max_lines` different lines with a span of each kind and as many without any are used, so what
    reaches the driver is bounded. Lines with spans come three times: as they are, with the span disguised, and with it
    spoilt and no longer a span. Without any base span the model has no weights and adds nothing.
    """
    texts = small_batches(docs).select(F.col(text_col).alias("text")).filter("text is not null")
    share = min(1.0, max_docs / max(texts.count(), 1))
    sample = texts.filter(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < int(share * (1 << 30)))
    rows = sample.mapInArrow(_training_rows, "line string, starts array<int>, ends array<int>, kinds array<string>").distinct()
    wanted = F.when(F.size("kinds") == 0, F.lit("none")).otherwise(F.col("kinds")[0])
    place = F.row_number().over(Window.partitionBy("kind").orderBy(F.xxhash64("line"), "line"))
    picked = rows.withColumn("kind", wanted).withColumn("place", place).filter(F.col("place") <= max_lines).orderBy("kind", "place").collect()
    rng, lines, gold = random.Random(seed), [], []

    def add(line: str, spans: list[Span], change: Callable | None, label: bool) -> None:
        text, at, own = "", 0, []
        for a, b, kind in spans:
            text += line[at:a]
            new = change(line[a:b], kind, rng) if change else line[a:b]
            if label:
                own.append((len(text), len(text) + len(new), kind))
            text, at = text + new, b
        lines.append(text + line[at:])
        gold.append(own)

    for r in picked:
        spans = list(zip(r["starts"], r["ends"], r["kinds"]))
        add(r["line"], spans, None, True)
        if spans:
            add(r["line"], spans, disguised, True)
            add(r["line"], spans, spoilt, False)
    return fit_spans(lines, gold)


# ---- spans of documents

def all_spans(text: str, model: SpanModel, caution: float) -> tuple[list[Span], list[Span]]:
    """(base spans, base spans and those that the model adds beside them)."""
    base = base_spans(text)
    added: set[Span] = set()
    parts, size = [], 0
    areas = regions(text) if model.weights.any() else []

    def look() -> None:
        joined, at = "\n".join(text[a:b] for a, b in parts), np.cumsum([0, *[b - a + 1 for a, b in parts]])
        for a, b, kind in model.best(joined, caution):
            k = int(np.searchsorted(at, a, side="right")) - 1
            move = parts[k][0] - int(at[k])
            added.add((a + move, b + move, kind))

    for area in areas:
        parts.append(area)
        size += area[1] - area[0]
        if size > PIECE or area is areas[-1]:
            look()
            parts, size = [], 0
    taken: list[Span] = []
    fixed = sorted((a, b) for a, b, _ in base)
    for a, b, kind in sorted(added):
        k = int(np.searchsorted([f[0] for f in fixed], b)) if fixed else 0
        if (not taken or taken[-1][1] <= a) and all(f[1] <= a for f in fixed[:k]):
            taken.append((a, b, kind))
    return base, sorted(base + taken, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


_SPANS = "array<struct<start: long, end: long, kind: string>>"
_SPAN_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))


def find_pii(docs: DataFrame, model: SpanModel, caution: float = 1.0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, base (spans of the patterns) and spans (base and added), as arrays of (start, end, kind).

    Positions are code points, the end exclusive. Base spans are the leftmost matches per kind that do not overlap and
    pass their test: e-mail addresses, IPv4 addresses (parts up to 255), cards (14 to 19 digits with a right check sum),
    phones (+ and 10 to 15 digits). Added spans overlap no base span and no other; they have at most MAX_TOKENS tokens
    and MAX_CHARS characters, on one line, and must score `caution` over no span (log odds).

    Null and empty texts have no spans; every row is judged by itself, whole, in time linear in its text; repeated rows have
    the same spans; a null id stays null; other columns are ignored; an empty table gives an empty table.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", 2 << 20):
            pairs = [all_spans(t or "", model, caution) for t in block.column("text").to_pylist()]
            told = [[[{"start": a, "end": b, "kind": k} for a, b, k in p[which]] for p in pairs] for which in (0, 1)]
            yield pa.RecordBatch.from_arrays([block.column("id"), *[pa.array(x, _SPAN_TYPE) for x in told]], names=["id", "base", "spans"])

    texts = small_batches(docs).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return texts.mapInArrow(run, f"id long, base {_SPANS}, spans {_SPANS}").withColumnRenamed("id", id_col)
