"""Secret scans: fixed patterns, and a character convolution over every candidate.

The base patterns (KINDS) always count. Beside them every token that could be a key
(a run of key characters, at least MIN_LENGTH long, with letters and digits, or without digits
at least LETTERS long, with a capital after a small letter in it) is scored
with its surrounding context by a small convolutional network in numpy: characters are
embedded, two widths of filters run over the window, the best response of each filter
feeds a logistic output. The window slides over the whole token, and the parts between
slashes and equal signs are looked at as well; the best response counts. It is trained on labelled findings: the base patterns' finds
(positive) and other candidates (negative) of every document, and seeded keys and
look-alikes of many formats, set into contexts of every document (``fitted``). Equal findings
count once, so copies of a text don't swell them. Half of the seeded findings train, with two
thirds of the others; on a quarter and the rest the output is calibrated (Platt). Then one
threshold for keyed and one for bare contexts is set: the highest (to a ten thousandth) that
still finds RECALL of the last quarter's keys that no base pattern matches, searched for in
their texts as any key is. Tokens above it that no base span
touches are added as kind ``model``; of a token that one touches, the parts that none does.

Fitting is spread: tasks cut the findings out of the texts, windows are dealt into shards of
about SHARD, each shard trains from the common weights and the mean of its results, weighted by
windows, begins the next round. What reaches the driver are the weights and counts of
scores by bins, whatever the size of the table.

Spans are in code points of the text, end exclusive. Defined cases: NULL text is
empty and has no spans; texts of any length are scanned whole; repeated rows are all
returned; a table without any finding still trains on the seeded ones; extra columns
pass through ``redacted``.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewatch.llm.common import discard, ship, written

KINDS = ("assign", "access", "hex", "model")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                    r"([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
KEY = r"[A-Za-z0-9+/_.=-]"
MIN_ASSIGN = 6
# Quick tests (linear time) for texts that can hold a find; the patterns above decide.
MAY_ASSIGN = "(?i)(password|passwd|secret|token|api_?key)"
MAY_HEX = "[0-9a-f]{24}"
MAY_MODEL = "[0-9]|[a-z][A-Z]"
DIGIT = re.compile(r"[0-9]")
MIXED = re.compile(r"[a-z][A-Z]")
PART = re.compile(r"[^/=]+")

MIN_LENGTH = 12
LETTERS = 16                      # least length of a key without digits
CANDIDATE = re.compile(f"(?<!{KEY}){KEY}{{{MIN_LENGTH},}}")
LEFT, INSIDE, RIGHT = 24, 40, 8   # characters of the window
SLIDE = 20                        # characters between two windows of a long token
SEEDED = 2400
HELD = 4800           # seeded findings, half of them keys, that set the thresholds
RECALL = 0.99
DIM, WIDTHS, FILTERS = 8, (3, 5), 16
EPOCHS, BATCH, RATE = 6, 64, 0.01
SHARD = 20_000        # windows that train together, about
ROUNDS = 3            # of several shards; a single one trains for EPOCHS
BINS = 10_000         # of scores, for the thresholds
TRAIN, CALIBRATE, HOLD = 0, 1, 2   # uses of a finding
REDACTED = "[SECRET]"

KEYED = re.compile(r"(pass|pwd|secret|token|key|auth|cred|bearer)[a-z_]*[\"']?\s*[:=]?\s*[\"']?$", re.I)


def base_spans(text: str, assign=True, access=True, hexes=True) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns, leftmost and non-overlapping per kind."""
    found = []
    if assign:
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text)
                  if m.end(2) - m.start(2) >= MIN_ASSIGN]
    if access:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    if hexes:
        found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return found


def _could_be_key(token: str) -> bool:
    if DIGIT.search(token):
        return len(token) >= MIN_LENGTH and any(c.isalpha() for c in token)
    return len(token) >= LETTERS and bool(MIXED.search(token))


def candidates(text: str):
    """(start, end) of the tokens that could be keys, longest runs of key characters."""
    for run in CANDIDATE.finditer(text):
        start, end = run.span()
        while end > start and text[end - 1] in ".-=":   # closing punctuation
            end -= 1
        if _could_be_key(text[start:end]):
            yield start, end


def parts(text: str, start: int, end: int):
    """(start, end) of the parts of a token, between / and =, that could be keys."""
    for m in PART.finditer(text, start, end):
        s, e = m.start(), m.end()
        while e > s and text[e - 1] in ".-":
            e -= 1
        if e - s < end - start and _could_be_key(text[s:e]):
            yield s, e


def views(text: str, start: int, end: int):
    """(start, end) of the windows of a token: its beginning, then slid on to its end, and the same
    of each part."""
    yield start, end
    for s, e in [(start, end), *parts(text, start, end)]:
        if s > start or e < end:
            yield s, e
        if e - s > INSIDE:
            yield from ((at, at + INSIDE) for at in range(s + SLIDE, e - INSIDE, SLIDE))
            yield e - INSIDE, e


def window(text: str, start: int, end: int) -> np.ndarray:
    """Character codes of the context and of the token's first characters, and its marks."""
    width = LEFT + INSIDE + RIGHT
    codes = np.zeros((2, width), dtype=np.int64)
    left = text[max(0, start - LEFT):start]
    inside = text[start:min(end, start + INSIDE)]
    right = text[end:end + RIGHT]
    for offset, part, mark in ((LEFT - len(left), left, 0), (LEFT, inside, 1),
                               (LEFT + INSIDE, right, 0)):
        for i, c in enumerate(part):
            o = ord(c)
            codes[0, offset + i] = o - 31 if 32 <= o < 127 else 96 if o >= 127 else 1
            codes[1, offset + i] = mark
    return codes


class Network:
    """Embedding, two widths of convolution, the best response of each, logistic output."""

    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.p = {"embed": rng.normal(0, 0.3, (97, DIM)), "out": rng.normal(0, 0.3, len(WIDTHS) * FILTERS),
                  "bias": np.zeros(1)}
        for w in WIDTHS:
            self.p[f"conv{w}"] = rng.normal(0, (w * (DIM + 1)) ** -0.5, (w * (DIM + 1), FILTERS))
            self.p[f"shift{w}"] = np.zeros(FILTERS)

    def _input(self, codes):
        return np.concatenate((self.p["embed"][codes[:, 0]], codes[:, 1, :, None]), axis=2)

    def forward(self, codes):
        x = self._input(codes)
        best, kept = [], {}
        for w in WIDTHS:
            n = x.shape[1] - w + 1
            views = np.concatenate([x[:, i:i + n] for i in range(w)], axis=2)
            act = views @ self.p[f"conv{w}"] + self.p[f"shift{w}"]
            where = act.argmax(axis=1)
            top = np.take_along_axis(act, where[:, None, :], axis=1)[:, 0]
            best.append(np.maximum(top, 0))
            kept[w] = views, where, top
        h = np.concatenate(best, axis=1)
        return h @ self.p["out"] + self.p["bias"][0], (h, kept)

    def gradients(self, codes, y):
        logit, (h, kept) = self.forward(codes)
        d = (1 / (1 + np.exp(-np.clip(logit, -50, 50))) - y) / len(y)
        g = {"out": h.T @ d, "bias": np.array([d.sum()]), "embed": np.zeros_like(self.p["embed"])}
        rows = np.arange(len(y))[:, None]
        for k, w in enumerate(WIDTHS):
            views, where, top = kept[w]
            out = self.p["out"][k * FILTERS:(k + 1) * FILTERS]
            da = d[:, None] * out * (top > 0)                     # (rows, filters)
            picked = views[rows, where]                           # (rows, filters, w * (DIM + 1))
            g[f"conv{w}"] = np.einsum("rf,rfc->cf", da, picked)
            g[f"shift{w}"] = da.sum(axis=0)
            back = (da[:, :, None] * self.p[f"conv{w}"].T).reshape(len(y), FILTERS, w, DIM + 1)
            for i in range(w):
                np.add.at(g["embed"], codes[rows, 0, where + i], back[:, :, i, :DIM])
        return g

    def train(self, codes, y, seed: int = 5, epochs: int = EPOCHS):
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(y))
            for at in range(0, len(y), BATCH):
                part = order[at:at + BATCH]
                step += 1
                for k, g in self.gradients(codes[part], y[part]).items():
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    self.p[k] -= RATE * (m[k] / (1 - 0.9 ** step)) / (
                        np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)


_LOWER, _UPPER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"


def _draw(rng, alphabet: str, n: int) -> str:
    return "".join(alphabet[i] for i in rng.integers(0, len(alphabet), n))


def seeded_findings(contexts: list[str], n: int, seed: int = 3, labels=None):
    """(text, start, end, label): keys and look-alikes of many formats in given contexts, in turn
    or by ``labels``."""
    rng = np.random.default_rng(seed)
    both, hexes = _LOWER + _UPPER + _DIGITS, "0123456789abcdef"
    words = [w for c in contexts for w in c.split() if w.isalpha()] or ["word", "text"]
    word = lambda: words[int(rng.integers(len(words)))]
    digits = lambda k: _draw(rng, _DIGITS, k)
    piece = lambda: (word, word, lambda: word() + digits(2), lambda: f"{word()}-{word()}")[
        int(rng.integers(4))]()
    path = lambda k: f"//{word()}.{word()}.com/" + "/".join(piece() for _ in range(k))
    keys = (
        lambda: _draw(rng, hexes, int(rng.choice([24, 32, 40, 48, 64]))),
        lambda: _draw(rng, hexes.upper(), int(rng.choice([24, 32, 40, 64]))),
        lambda: _draw(rng, both, int(rng.integers(16, 48))),
        lambda: _draw(rng, both + "+/", int(rng.integers(24, 64))) + "=" * int(rng.integers(0, 3)),
        lambda: "AKIA" + _draw(rng, _UPPER + _DIGITS, 16),
        lambda: _draw(rng, _LOWER, 3) + "_" + _draw(rng, both, 36),
        lambda: "eyJ" + _draw(rng, both, 20) + "." + _draw(rng, both + "_-", 30),
        lambda: _draw(rng, both, 8) + "-" + _draw(rng, both, 24),
        lambda: _draw(rng, _LOWER, 1) + _draw(rng, _UPPER + _LOWER, int(rng.integers(15, 47))),
    )
    others = (
        lambda: f"mail{digits(1)}.{word().lower()}.com",
        lambda: f"20{digits(2)}-0{digits(1)}-1{digits(1)}T{digits(2)}.{digits(3)}Z",
        lambda: f"{word()}_{word()}_{digits(int(rng.integers(1, 5)))}",
        lambda: f"{word()}/{word()}/{word()}{digits(2)}",
        lambda: f"{word()}-{word()}-{digits(2)}",
        lambda: f"v{digits(1)}.{digits(2)}.{digits(1)}-{word()}",
        lambda: f"{word()}{digits(4)}.{word()}.{digits(1)}",
        lambda: f"{word()}={digits(3)}={word()}",
        lambda: f"{digits(4)}-{digits(4)}-{word()}-{digits(4)}",
        lambda: path(int(rng.integers(3, 12))) + f"/{word()}-{word()}-{digits(3)}.html",
        lambda: "".join(word().title() for _ in range(int(rng.integers(2, 6)))),
        lambda: word().lower() + "".join(word().title() for _ in range(int(rng.integers(2, 6)))),
        lambda: path(int(rng.integers(2, 8))) + "/" + word().title() + word().title(),
        lambda: path(int(rng.integers(2, 8))) + f"/20{digits(2)}/{digits(2)}/{word()}_{word()}={digits(2)}",
    )
    names = ("password", "secret", "token", "api_key", "apikey", "auth", "Bearer", "key", "pwd",
             "access_token", "client_secret", "credentials")
    joins = (" = ", "=", ": ", ":", ' = "', "='", " ")
    out = []
    for i in range(n):
        label = labels[i] if labels else int(i % 2 == 0)
        family = keys if label else others
        token = family[int(rng.integers(len(family)))]()
        context = contexts[int(rng.integers(len(contexts)))] if contexts else "some text here"
        at = int(rng.integers(0, len(context) + 1))
        left, right = context[max(0, at - 60):at], context[at:at + 30]
        before = after = ""
        if label and rng.random() < 0.2:   # in a path or a chain of parameters
            before = path(int(rng.integers(0, 8))) + "/" if rng.random() < 0.7 else f"{word()}={word()}="
            after = "" if rng.random() < 0.6 else f"/{piece()}"
        # most keys are named, some are bare; a name alone makes no key
        if rng.random() < (0.6 if label else 0.15):
            left += " " + names[int(rng.integers(len(names)))] + joins[int(rng.integers(len(joins)))]
        else:
            left += " "
        left += before
        out.append((left + token + after + " " + right, len(left), len(left) + len(token), label))
    return out


def _touching(spans):
    """A test whether (start, end) touches one of ``spans``."""
    ends: list[int] = []   # of the spans by start, raised to the furthest end so far
    starts = sorted((a, b) for a, b, _ in spans)
    for _, b in starts:
        ends.append(max(b, ends[-1] if ends else 0))
    starts = [a for a, _ in starts]

    def touched(s, e):
        before = bisect_left(starts, e)  # spans that begin before the token ends
        return before > 0 and ends[before - 1] > s
    return touched


def findings(texts: list[str]):
    """(text, start, end, label) of every candidate of ``texts``, labelled by the base patterns."""
    for text in texts:
        touched = _touching(base_spans(text))
        for start, end in candidates(text):
            label = int(touched(start, end))
            yield text[max(0, start - LEFT - 1):end + RIGHT], start - max(0, start - LEFT - 1), \
                end - max(0, start - LEFT - 1), label


def _platt(logit, y, times=1.0, rounds: int = 200):
    """Slope and shift of a logistic fit to (logit, label), each so many ``times``, by Newton's
    method."""
    a, b = 1.0, 0.0
    ones, zeros = (times * y).sum(), (times * (1 - y)).sum()
    target = np.where(y == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a * logit + b, -50, 50)))
        g = np.array([(times * (p - target) * logit).sum(), (times * (p - target)).sum()])
        w = times * (p * (1 - p) + 1e-9)
        hess = np.array([[(w * logit ** 2).sum(), (w * logit).sum()],
                         [(w * logit).sum(), w.sum()]]) + 1e-6 * np.eye(2)
        step = np.linalg.solve(hess, g)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-9:
            break
    return float(a), float(b)


def _is_keyed(text: str, start: int) -> bool:
    return bool(KEYED.search(text[max(0, start - LEFT):start]))


def fit(texts: list[str]) -> dict:
    """Trained network, calibration and thresholds from a list of texts in memory (``fitted``: of
    a table)."""
    rows = list(findings(texts)) + seeded_findings(texts, SEEDED)
    # a positive's beginning is a key; of a negative no view is
    seen = [(i, t, a, b, label) for i, (t, start, end, label) in enumerate(rows)
            for a, b in ([(start, end)] if label else views(t, start, end))]
    codes = np.stack([window(t, a, b) for _, t, a, b, _ in seen])
    y = np.array([label for *_, label in seen], dtype=np.float64)
    aside = np.array([i for i, *_ in seen]) % 3 == 0  # a third, for the calibration
    net = Network()
    net.train(codes[~aside], y[~aside])
    logit = net.forward(codes[aside])[0]
    a, b = _platt(logit, y[aside])
    model = {"net": net, "slope": a, "shift": b}
    model["thresholds"] = recall_points(model, seeded_findings(texts, HELD, seed=4))
    return model


def scores(text: str, tokens, model):
    """(index of the token, calibrated score, keyed) of every view of every token."""
    seen = ((i, s, e) for i, token in enumerate(tokens) for s, e in views(text, *token))
    while part := list(islice(seen, 256)):
        logit = model["net"].forward(np.stack([window(text, s, e) for _, s, e in part]))[0]
        p = 1 / (1 + np.exp(-np.clip(model["slope"] * logit + model["shift"], -50, 50)))
        yield from ((i, float(x), _is_keyed(text, s)) for (i, s, _), x in zip(part, p))


def best_score(model, text: str, start: int, end: int):
    """(keyed, score) of a key that no base pattern matches, by way of candidates(): -1 if it yields
    none. None for other keys."""
    if _touching(base_spans(text))(start, end):
        return None
    kind = _is_keyed(text, start)
    tokens = [(s, e) for s, e in candidates(text) if s < end and start < e]
    return kind, max((p for _, p, k in scores(text, tokens, model) if k == kind), default=-1.0)


def _recall_at(n: int, misses: int) -> int:
    """Of ``n`` keys, ``misses`` without a score: how many scores may lie under the threshold."""
    return max(int((1 - RECALL) * n) - misses, 0)


def recall_points(model, rows) -> dict[bool, float]:
    """For keyed and bare contexts, the highest threshold that finds RECALL of the keys in ``rows``
    that no base pattern matches; keys that candidates() does not yield are misses."""
    best: dict[bool, list] = {True: [], False: []}
    for text, start, end, label in rows:
        if label and (one := best_score(model, text, start, end)):
            best[one[0]].append(one[1])
    points = {}
    for kind, found in best.items():
        reached = sorted(p for p in found if p >= 0)
        points[kind] = reached[_recall_at(len(found), len(found) - len(reached))] if reached else 1.0
    return points


def _packed(text: str, start: int, end: int) -> bytes:
    return window(text, start, end).astype(np.uint8).tobytes()


def _unpacked(codes) -> np.ndarray:
    return np.frombuffer(b"".join(codes), np.uint8).reshape(
        len(codes), 2, LEFT + INSIDE + RIGHT).astype(np.int64)


_ROWS = pa.schema([("use", pa.int32()), ("label", pa.int32()), ("codes", pa.binary()),
                   ("text", pa.string()), ("start", pa.int32()), ("end", pa.int32())])


def _training_rows(batches, seeds: int):
    """Of every text, the windows of its findings and of ``seeds`` seeded ones; those that set the
    thresholds go with their text."""
    def of(text, may):
        for t, start, end, label in findings([text] if may else []):
            first = _packed(t, start, end)
            use = CALIBRATE if zlib.crc32(first) % 3 == 0 else TRAIN
            yield use, label, first, None, None, None
            if not label:
                yield from ((use, 0, _packed(t, a, b), None, None, None)
                            for a, b in islice(views(t, start, end), 1, None))
        h = zlib.crc32(text.encode())
        uses = [(TRAIN, TRAIN, CALIBRATE, HOLD)[(h + i) // 2 % 4] for i in range(seeds)]
        labels = [1 if use == HOLD else (h + i) % 2 for i, use in enumerate(uses)]
        for use, (t, start, end, label) in zip(uses, seeded_findings([text], seeds, h, labels)):
            if use == HOLD:
                yield use, label, None, t, start, end
            else:
                yield from ((use, label, _packed(t, a, b), None, None, None) for a, b in
                            ([(start, end)] if label else views(t, start, end)))

    for batch in batches:
        texts = batch.column(0)
        may = pc.match_substring_regex(texts, MAY_MODEL).to_pylist()
        rows = (row for t, m in zip(texts, may) for row in of(t.as_py(), m))
        while part := list(islice(rows, 4096)):
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*part), _ROWS)], schema=_ROWS)


def _trained(windows: DataFrame, n: int) -> Network:
    """The network trained on ``n`` windows (codes, label), shard by shard, in rounds."""
    shards = -(-n // SHARD)
    dealt = windows.select("codes", "label", F.expr(
        f"CAST(pmod(xxhash64(codes, label), {shards}L) AS INT)").alias("shard")).repartition(
        shards, "shard")
    net = Network()
    sizes = {k: v.shape for k, v in net.p.items()}
    ends = np.cumsum([int(np.prod(shape)) for shape in sizes.values()])

    def network(weights) -> Network:
        out = Network()
        out.p = {k: part.reshape(shape).copy() for (k, shape), part in
                 zip(sizes.items(), np.split(weights, ends[:-1]))}
        return out

    def flat(of: Network) -> np.ndarray:
        return np.concatenate([of.p[k].ravel() for k in sizes])

    for turn in range(EPOCHS if shards == 1 else ROUNDS):
        weights = flat(net)

        def train(rows: pd.DataFrame) -> pd.DataFrame:
            rows = rows.sort_values(["codes", "label"])
            own = network(weights)  # noqa: B023
            own.train(_unpacked(rows["codes"].tolist()),
                      rows["label"].to_numpy(np.float64), seed=turn, epochs=1)  # noqa: B023
            return pd.DataFrame({"i": np.arange(len(weights)), "v": flat(own) * len(rows)})  # noqa: B023

        # decimals add up to the same sum in any order
        summed = dealt.groupBy("shard").applyInPandas(train, "i int, v double").groupBy("i").agg(
            F.sum(F.col("v").cast("decimal(28,12)")).cast("double").alias("v")).collect()
        net = network(np.array([r["v"] for r in sorted(summed, key=lambda r: r["i"])]) / n)
    return net


def fitted(docs: DataFrame) -> dict:
    """Trained network, calibration and thresholds from all texts of a table."""
    texts = docs.select("text").where("text IS NOT NULL")
    # copies seed the same findings: few different texts seed several each
    different = texts.agg(F.approx_count_distinct(F.xxhash64("text"))).first()[0]
    if not different:
        return fit([])
    seeds = -(-(SEEDED + HELD) // different)
    rows = written(texts.mapInArrow(
        lambda batches: _training_rows(batches, seeds),
        "use int, label int, codes binary, text string, start int, end int").distinct(),
        "secrets-findings")
    model = {"net": _trained(rows.where(F.col("use") == TRAIN),
                             rows.where(F.col("use") == TRAIN).count())}

    def logits(batches):
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                z = model["net"].forward(_unpacked(part.column(0).to_pylist()))[0]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.rint(np.clip(z, -50, 50) * 100).astype(np.int32)), part.column(1)],
                    names=["z", "label"])

    seen = (rows.where(F.col("use") == CALIBRATE).select("codes", "label")
            .mapInArrow(logits, "z int, label int").groupBy("z", "label").count()
            .orderBy("z", "label").toPandas())
    model["slope"], model["shift"] = _platt(
        seen["z"].to_numpy() / 100, seen["label"].to_numpy(np.float64),
        seen["count"].to_numpy(np.float64))

    def best(batches):
        for batch in batches:
            found = [one for t, a, b in zip(*(c.to_pylist() for c in batch.columns))
                     if (one := best_score(model, t, a, b))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in found], pa.bool_()),
                 pa.array([p for _, p in found], pa.float64())], names=["keyed", "p"])

    held = (rows.where(F.col("use") == HOLD).select("text", "start", "end")
            .mapInArrow(best, "keyed boolean, p double")
            .groupBy("keyed", F.expr(f"CAST(floor(p * {BINS}) AS INT)").alias("bin"))
            .agg(F.count("*").alias("n"), F.min("p").alias("p")).collect())
    model["thresholds"] = recall_bins(held)
    discard(rows)
    return model


def recall_bins(held) -> dict[bool, float]:
    """The points of ``recall_points``, from rows of (keyed, bin, n, p): the least score p of the
    bin that holds the point. Misses have a p under 0."""
    points = {}
    for kind in (True, False):
        own = sorted((r for r in held if r["keyed"] == kind), key=lambda r: r["bin"])
        under = _recall_at(sum(r["n"] for r in own), sum(r["n"] for r in own if r["p"] < 0))
        points[kind] = 1.0
        for r in (r for r in own if r["p"] >= 0):
            if under < r["n"]:
                points[kind] = r["p"]
                break
            under -= r["n"]
    return points


def model_spans(text: str, spans, model) -> list[tuple[int, int, str]]:
    """Candidates over their threshold that touch no span of ``spans``."""
    touched = _touching(spans)
    free = []
    for s, e in candidates(text):
        if not touched(s, e):
            free.append((s, e))
        else:
            free += [part for part in parts(text, s, e) if not touched(*part)]
    over = {i for i, p, keyed in scores(text, free, model) if p >= model["thresholds"][keyed]}
    return [(*free[i], "model") for i in sorted(over)]


def scan_batch(texts: pa.Array, model) -> list[list[tuple[int, int, str]]]:
    """Sorted spans of each text; texts that can hold none are passed by in linear time."""
    texts = pc.fill_null(texts, "")
    flags = [pc.match_substring_regex(texts, p).to_pylist() for p in (MAY_ASSIGN, MAY_HEX, MAY_MODEL)]
    access = pc.match_substring(texts, "AKIA").to_pylist()
    out = []
    for i, (assign, hexes, may) in enumerate(zip(*flags)):
        if not (assign or hexes or may or access[i]):
            out.append([])
            continue
        text = texts[i].as_py()
        spans = base_spans(text, assign, access[i], hexes)
        if may:
            spans += model_spans(text, spans, model)
        out.append(sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]))))
    return out


def redact(text: str, spans) -> str:
    """The text with every run of touching or overlapping spans replaced by a mark."""
    out, at = [], 0
    for start, end, _ in spans:
        if start >= at:
            out += [text[at:start], REDACTED]
        at = max(at, end)
    return "".join(out) + text[at:]


def _udf(docs: DataFrame, kind: str, of):
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(fitted(docs))

    @F.arrow_udf(kind)
    def run(text: pa.Array) -> pa.Array:
        return of(text, scan_batch(text, shared.value))
    return run


def _as_structs(_, scans):
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    return pa.array([[{"kind": k, "start": a, "end": b} for a, b, k in s] for s in scans], kind)


def _as_text(texts, scans):
    return pa.array([redact(t, s) if s else t for t, s in zip(texts.to_pylist(), scans)], pa.string())


def secret_spans(docs: DataFrame) -> DataFrame:
    """doc_id and ``spans``, an array of (kind, start, end) by start, then kind."""
    find = _udf(docs, "array<struct<kind: string, start: int, end: int>>", _as_structs)
    return docs.select("doc_id", find(F.coalesce("text", F.lit(""))).alias("spans"))


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of its text replaced by REDACTED and n_chars brought up to date."""
    clean = _udf(docs, "string", _as_text)
    text = docs.select("*").withColumn("text", clean(F.col("text")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        text = text.withColumn("n_chars", F.length("text").cast(kind))
    return text.select(*docs.columns)
