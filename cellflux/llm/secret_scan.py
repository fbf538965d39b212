"""Secrets: exact patterns, and a character convolutional network over other candidates.

Base findings follow three fixed patterns.  The network judges every other
run of ``LEAST`` or more characters of a key's alphabet: what base findings
leave of it, if that is long enough.  It sees ``INSIDE`` characters and what
stands around them: characters are embedded, convolved, max-pooled, and a
small dense layer gives a logit.  A longer candidate is judged by windows that
overlap by half, and the likeliest one counts.

It is trained on every distinct window of either label that the texts give,
three quarters of them, by the tasks that hold them: from common parameters
each task goes through its windows of a slice (numpy, Adam), and the driver
averages what the tasks return, weighted by rows.  Only parameters pass through
it.  Secrets are the values of base
findings, and in the place of each a key of another make (``minted``: mixed
case with signs, prefixed, dotted, upper case, in a path), as base findings
are of few makes.  The others are identifiers put together from the short words of the
corpus, in their places in the prose (joined words, names, paths, dates, hosts, addresses), and
long words: letters in one case between spaces or stops that a text holds more
than once, as vocabulary is.  Nothing else that is judged is among them, so an
unmatched secret isn't shown as ordinary unless it looks like such a word.
Every window is also shown without surroundings, and every secret also in
those of an ordinary window, so that the value counts and not the key word
before it.  The other quarter is held out, whole: it calibrates the
logit to a probability (sums over all of it) and sets the threshold, the largest that still finds
``RECALL`` of the held-out secrets (their exact quantile).  Candidates at or above it are added as
spans of kind ``model``; base findings always stay.

The texts are read twice, for the windows to learn from and to be judged; in between only the
distinct windows are kept.

Defined results: null or empty text has no spans; without findings of both
labels no span is added; rows that repeat are scanned alike; a text of any
length is scanned whole; an empty table gives no rows; extra columns are
ignored.
"""

from __future__ import annotations

import hashlib
import pickle
import re
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellflux.llm.common import discard, materialise, prepare, table
from cellflux.llm.toxicity import fit

#: The base patterns.
ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # runs are maximal, so shorter ones can be left out at once
LEAST_ASSIGN, LEAST_ACCESS = 12, 18

LEAST = 12  # characters of a candidate
OTHER = re.compile(r"[A-Za-z0-9+/_=-]+(?:\.[A-Za-z0-9+/_=-]+)*")  # dots inside only
SHORT = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z]{2,11}(?![A-Za-z0-9+/_=-])")  # words that are no candidates
LONG_WORD = re.compile(r"(?<![A-Za-z0-9+/_=-])(?:[A-Za-z][a-z]{11,}|[A-Z]{12,})(?![A-Za-z0-9+/_=-])")
KINDS = ["assign", "access", "hex"]
BEFORE, INSIDE, AFTER = 16, 40, 8
WIDE = BEFORE + INSIDE + AFTER
RECALL = 0.98
LEAST_SEEN = 96_000  # windows that training goes through, by repeated passes over fewer
PER_TASK, TASKS, SLICES = 20_000, 64, 4  # windows trained on at once; tasks of a round; rounds of a pass
LENT = 4  # identifiers that a document lends to the windows
AT_ONCE = 1024  # windows judged at once

SHOWN = T.StructType([T.StructField("window", T.StringType()), T.StructField("y", T.IntegerType())])


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base findings, in code points, by start and kind."""
    out = []
    if ":" in text or "=" in text:
        out += [(0, *m.span()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= LEAST_ASSIGN]
    if "AKIA" in text:
        out += [(1, *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    out += [(2, *m.span()) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], s[0]))


def window(text: str, a: int, b: int) -> str:
    """The characters around and (the first ones) inside a candidate, in fixed places; \\0 where there is none."""
    return text[max(0, a - BEFORE) : a].rjust(BEFORE, "\0") + text[a : min(b, a + INSIDE)].ljust(INSIDE, "\0") + text[b : b + AFTER].ljust(AFTER, "\0")


def windows(text: str, a: int, b: int) -> Iterator[str]:
    """Windows over the whole candidate: they overlap by half, and the last one ends with it."""
    for i in range(a, max(a + 1, b - INSIDE), INSIDE // 2):
        yield window(text, i, min(b, i + INSIDE))
    if b - a > INSIDE:
        yield window(text, b - INSIDE, b)


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """(start, end) of what the base findings leave of each run, where it is long enough."""
    out, k = [], 0
    spans = sorted((a, b) for _, a, b in base)
    for m in OTHER.finditer(text):
        at, end = m.span()
        if end - at < LEAST:
            continue
        while k < len(spans) and spans[k][1] <= at:
            k += 1
        for a, b in spans[k:]:
            if a >= end or at >= end:
                break
            if a - at >= LEAST:
                out.append((at, a))
            at = max(at, b)
        if end - at >= LEAST:
            out.append((at, end))
    return out


def values(text: str) -> list[tuple[int, int]]:
    """(start, end) of the values of the base findings: of an assignment what is assigned."""
    out = [m.span(1) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= LEAST_ASSIGN] if ":" in text or "=" in text else []
    return out + [(a, b) for k, a, b in base_spans(text) if k]


def identifier(words: list[str], style: int, n: int) -> str:
    """An ordinary run of ``LEAST`` or more characters made of short words; ``n``: a number to choose by."""
    if style == 1:
        v = "_".join(words)
    elif style == 2:
        v = "-".join(words) + (f"-{n % 100}" if n & 256 else "")
    elif style == 3:
        v = "/" + "/".join(words)
    elif style == 4:
        v = words[0] + "".join(w[0].upper() + w[1:] for w in words[1:])
    elif style == 5:
        v = f"{1990 + n % 60}-{1 + n % 12:02d}-{1 + n % 28:02d}-{words[0]}"
    elif style == 6:
        v = words[0].lower() + "=" + "_".join(words[1:]) + str(n % 1000)
    elif style == 7:
        v = ".".join(words)
    elif style == 8:
        v = f"www.{words[0].lower()}.{('com', 'org', 'net')[n % 3]}/" + "/".join(words[1:])
    elif style == 9:  # an address or a version
        v = ".".join(str((n >> k) % 256 + (100 if n & 1 else 0)) for k in (0, 7, 14, 21))
        v = v if len(v) >= LEAST else "192.168." + v
    else:  # a long word
        v = words[0] + "".join(w.lower() for w in words[1:])
        v = v.upper() if n & 3840 == 0 else v
    return v


LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
MAKES = 7


def minted(draw: np.random.Generator, make: int) -> str:
    """A random key of a make that services hand out."""
    of = lambda chars, n: "".join(chars[i] for i in draw.integers(len(chars), size=n))
    every, n = LOWER + UPPER + DIGITS, int(draw.integers(0, 13))
    if make == 1:  # a prefix, and what it is for
        return of(LOWER, 2 + n % 3) + "_" + ("live_", "test_", "")[n % 3] + of(every, 24 + n)
    if make == 2:  # three dotted parts
        return "eyJ" + of(every + "_-", 17 + n) + ".eyJ" + of(every + "_-", 30 + 3 * n) + "." + of(every + "_-", 43)
    if make == 3:  # upper case
        return of(UPPER[:6] + DIGITS if n % 2 else UPPER + DIGITS, 20 + n)
    if make == 4:  # parts of a path
        return "/".join(["", of(UPPER + DIGITS, 9 + n % 3), of(UPPER + DIGITS, 9 + n % 4), of(every, 24)])
    if make == 5:  # short
        return of(every, LEAST + n % 7)
    return of(every + ("+/" if make == 0 else ""), 40 if make == 0 else 20 + n)


def shown(text: str | None) -> list[dict]:
    """Windows to learn from: the values of the base findings (1), and some identifiers made of the text's short words and its long words (0)."""
    text = text or ""
    found = values(text)
    out = [{"window": w, "y": 1} for a, b in found for w in windows(text, a, b)]
    draw = np.random.default_rng(int.from_bytes(hashlib.md5(text.encode("utf-8", "surrogatepass")).digest()[:8], "big"))
    for a, b in found[:LENT]:
        make, before = int(draw.integers(MAKES + 3)), text[max(0, a - BEFORE) : a]
        v = minted(draw, make if make < MAKES else 5)  # short ones are the hardest
        out += [{"window": w, "y": 1} for w in windows(before + v + text[b : b + AFTER], len(before), len(before) + len(v))]
    for _ in range(LENT if text else 0):
        n, style, most = int(draw.integers(1 << 30)), int(draw.integers(12)), int(draw.integers(2, 10))
        most = most if style in (1, 3) else min(most, 4)
        at, got, long = int(draw.integers(len(text))), [], 0
        for m in SHORT.finditer(text, at, at + 400):
            got.append(m)
            long += m.end() - m.start()
            if len(got) >= most and long >= LEAST:
                break
        if long >= LEAST and len(got) > 1:
            a, b = got[0].start(), got[-1].end()
            v = identifier([m.group() for m in got], style, n)
            before = text[max(0, a - BEFORE) : a]
            w = list(windows(before + v + text[b : b + AFTER], len(before), len(before) + len(v)))
            out.append({"window": w[n % len(w)], "y": 0})
    long_words = [m for m in LONG_WORD.finditer(text)]
    times = Counter(m.group() for m in long_words)
    again = [m for m in long_words if times[m.group()] > 1 and m.span() not in found]
    return out + [{"window": window(text, *m.span()), "y": 0} for m in again[:LENT]]


def sampled(docs: DataFrame) -> DataFrame:
    """Distinct windows and their labels (secret, if seen as both)."""
    def run(batches):
        for b in batches:
            for t in b.column("text").to_pylist():
                if got := shown(t):
                    yield pa.RecordBatch.from_pydict({"window": [g["window"] for g in got], "y": pa.array([g["y"] for g in got], pa.int32())})

    return docs.select("text").mapInArrow(run, SHOWN).groupBy("window").agg(F.max("y").alias("y"))


# ---------------------------------------------------------------------------
# the network
# ---------------------------------------------------------------------------

#: Character codes: letters and digits of their own, common signs, all else.
CODES = {c: i + 2 for i, c in enumerate("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789=:\"'_-/+. \n@,;")} | {"\0": 0}
DIM, WIDTH, FILTERS, HIDDEN = 8, 5, 32, 24


CODE_OF = np.array([CODES.get(chr(i), 1) for i in range(129)], np.int64)


def encode(windows: list[str]) -> np.ndarray:
    at = np.frombuffer("".join(windows).encode("utf-32-le", "surrogatepass"), np.uint32)
    return CODE_OF[np.minimum(at, 128)].reshape(-1, WIDE)


class Adam:
    """Moments of the gradients, and the number of steps."""

    def __init__(self, p: dict[str, np.ndarray]):
        self.m, self.v, self.step = {k: np.zeros_like(a) for k, a in p.items()}, {k: np.zeros_like(a) for k, a in p.items()}, 0

    def update(self, p: dict[str, np.ndarray], gradients: dict[str, np.ndarray], rate: float = 3e-3) -> None:
        self.step += 1
        for k, g in gradients.items():
            self.m[k] = 0.9 * self.m[k] + 0.1 * g
            self.v[k] = 0.999 * self.v[k] + 0.001 * g * g
            p[k] -= rate * (self.m[k] / (1 - 0.9**self.step)) / (np.sqrt(self.v[k] / (1 - 0.999**self.step)) + 1e-8)


class CharNet:
    """Embedding, one convolution, max-pooling, one hidden layer, logit."""

    def __init__(self, seed: int = 5):
        r = np.random.default_rng(seed)
        n = max(CODES.values()) + 1
        self.seen = 0  # rows that training has gone through
        self.p = {
            "e": r.normal(0, 0.5, (n, DIM)), "k": r.normal(0, (2 / (WIDTH * DIM)) ** 0.5, (WIDTH * DIM, FILTERS)), "kb": np.zeros(FILTERS),
            "h": r.normal(0, (2 / FILTERS) ** 0.5, (FILTERS, HIDDEN)), "hb": np.zeros(HIDDEN), "o": r.normal(0, (1 / HIDDEN) ** 0.5, HIDDEN), "ob": np.zeros(1),
        }

    def forward(self, x: np.ndarray) -> tuple[np.ndarray, tuple]:
        p = self.p
        e = p["e"][x]
        cols = np.concatenate([e[:, j : WIDE - WIDTH + 1 + j] for j in range(WIDTH)], axis=2)
        z = cols @ p["k"] + p["kb"]
        at = z.argmax(axis=1)
        top = np.maximum(np.take_along_axis(z, at[:, None], 1)[:, 0], 0)
        u = np.maximum(top @ p["h"] + p["hb"], 0)
        return u @ p["o"] + p["ob"][0], (cols, at, top, u)

    def logits(self, x: np.ndarray, rows: int = 256) -> np.ndarray:
        return np.concatenate([np.zeros(0), *(self.forward(x[i : i + rows])[0] for i in range(0, len(x), rows))])

    def train(self, x: np.ndarray, y: np.ndarray, rounds: int = 12, seed: int = 6) -> None:
        """Adam on the logistic loss; both labels weigh the same."""
        weight = np.where(y == 1, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))
        self.go_through(x, y, weight, Adam(self.p), rounds, np.random.default_rng(seed))

    def go_through(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray, adam: Adam, rounds: int, draw: np.random.Generator, batch: int = 64) -> None:
        for _ in range(rounds):
            order = draw.permutation(len(x))
            for i in range(0, len(x), batch):
                at = order[i : i + batch]
                adam.update(self.p, self.gradients(x[at], y[at], weight[at]))

    def gradients(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        p = self.p
        z, (cols, at, top, u) = self.forward(x)
        d = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * weight / len(x)
        du = np.outer(d, p["o"]) * (u > 0)
        dt = (du @ p["h"].T) * (top > 0)
        n = np.arange(len(x))[:, None]
        picked = cols[n, at]  # the columns that were the maximum of each filter
        dk = np.einsum("nf,nfc->cf", dt, picked)
        back = (dt[:, :, None] * p["k"].T[None]).reshape(len(x), FILTERS, WIDTH, DIM)
        de = np.zeros_like(p["e"])
        for j in range(WIDTH):
            np.add.at(de, x[n, at + j], back[:, :, j])
        return {"e": de, "k": dk, "kb": dt.sum(0), "h": top.T @ du, "hb": du.sum(0), "o": u.T @ d, "ob": np.array([d.sum()])}


def forms(windows: list[str], y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of what a network is shown, the label and the window of each: a window, it without surroundings, and a secret in those of an ordinary window."""
    x = encode(windows)
    bare, plain, secret = x.copy(), np.flatnonzero(y == 0), np.flatnonzero(y == 1)
    bare[:, :BEFORE] = bare[:, BEFORE + INSIDE :] = 0
    secret = secret if len(plain) else secret[:0]
    moved = x[secret]
    for i, at in enumerate(secret):
        like = x[plain[int.from_bytes(hashlib.md5(windows[at].encode("utf-8", "surrogatepass")).digest()[2:6], "big") % len(plain)]]
        moved[i, :BEFORE], moved[i, BEFORE + INSIDE :] = like[:BEFORE], like[BEFORE + INSIDE :]
    of = np.concatenate([np.arange(len(y)), np.arange(len(y)), secret])
    return np.concatenate([x, bare, moved]), y[of], of


class Model:
    """A trained network, its calibration and its threshold; made of few windows at one place, or of a table by ``learn``."""

    def __init__(self, windows: list[str], labels: list[int]):
        fold = np.array([hashlib.md5(w.encode()).digest()[1] % 4 for w in windows])
        x, y, of = forms(windows, np.array(labels, float))
        self.net = CharNet()
        train, held = fold[of] != 0, fold[of] == 0
        self.net.train(x[train], y[train], rounds=passes(len(windows)))
        z = self.net.logits(x[held])
        self.scale = fit(z[:, None], y[held]) if 0 < y[held].sum() < held.sum() else np.array([0.0, 1.0])
        p = np.sort(self.calibrated(z)[y[held] == 1])
        self.threshold = float(p[int(len(p) * (1 - RECALL))]) if len(p) else 1.0

    @classmethod
    def of(cls, net: CharNet, scale: np.ndarray, least: float | None) -> Model:
        """``least``: the place of the threshold on the calibrated scale; none: nothing is added."""
        out = cls.__new__(cls)
        out.net, out.scale = net, scale
        out.threshold = float(1 / (1 + np.exp(-np.clip(least, -30, 30)))) if least is not None else 1.0
        return out

    def calibrated(self, z: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale[0] + self.scale[1] * z, -30, 30)))

    def probability(self, windows: list[str]) -> np.ndarray:
        return self.calibrated(self.net.logits(encode(windows))) if windows else np.zeros(0)


def passes(n: int) -> int:
    """How often training goes through n windows: few are gone through more often."""
    return min(64, max(12 if n <= PER_TASK else 2, LEAST_SEEN // max(1, n)))


def dealt(c: DataFrame, n: int) -> DataFrame:
    """About ``n`` windows over tasks, in an order that reruns share."""
    tasks = min(TASKS, -(-n // PER_TASK))
    return (c.repartition(tasks, "window") if tasks > 1 else c.repartition(1)).sortWithinPartitions("h", "window").select("window", "y")


def chunks(batches) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Codes and labels of a task's windows in all forms, of up to ``PER_TASK`` windows at once."""
    windows, y = [], []
    for b in batches:
        windows += b.column("window").to_pylist()
        y += b.column("y").to_pylist()
        if len(windows) >= PER_TASK:
            yield forms(windows, np.array(y, float))[:2]
            windows, y = [], []
    if windows:
        yield forms(windows, np.array(y, float))[:2]


def trained(c: DataFrame, n: dict[int, int]) -> CharNet:
    """A network that has seen every window of ``c``, each as often; n: windows by label."""
    rows = {0: 2 * n[0], 1: (3 if n[0] else 2) * n[1]}
    weigh = np.array([0.5 * sum(rows.values()) / max(1, rows[k]) for k in (0, 1)])
    net, all_ = CharNet(), sum(n.values())
    state, often = (net.p, Adam(net.p)), passes(all_)
    few = all_ <= PER_TASK  # one task, all passes at once
    for k in range(1 if few else often * SLICES):
        start, rounds = pickle.dumps(state), often if few else 1

        def run(batches, start=start, rounds=rounds, k=k):
            net = CharNet()
            net.p, adam = pickle.loads(start)
            seen, draw = 0, np.random.default_rng(6 + k)
            for x, y in chunks(batches):
                net.go_through(x, y, weigh[y.astype(int)], adam, rounds, draw)
                seen += len(x) * rounds
            if seen:
                yield pa.RecordBatch.from_pydict({"seen": [seen], "state": [pickle.dumps((net.p, adam))]})

        part = c if few else c.where(F.pmod(F.shiftright("h", 8), F.lit(SLICES)) == k % SLICES)
        got = dealt(part, all_).mapInArrow(run, "seen long, state binary").collect()  # parameters of at most TASKS tasks, 80 KB each
        total, mean = 0, None
        for r in got:
            p, adam = pickle.loads(r["state"])
            total += r["seen"]
            if mean is None:
                mean = (p, adam)
                continue
            share = r["seen"] / total
            for into, new in ((mean[0], p), (mean[1].m, adam.m), (mean[1].v, adam.v)):
                for name, a in new.items():
                    into[name] += share * (a - into[name])
            mean[1].step = max(mean[1].step, adam.step)
        net.seen += total
        state = mean or state
    net.p = state[0]
    return net


def scaled(held: DataFrame) -> np.ndarray:
    """``toxicity.fit`` of the logits z to the labels y, by sums over all rows."""
    w, keep = np.zeros(2), np.array([1e-6, 0.05])
    for _ in range(60):
        p = 1 / (1 + F.exp(-F.least(F.greatest(F.lit(float(w[0])) + F.lit(float(w[1])) * F.col("z"), F.lit(-30.0)), F.lit(30.0))))
        v, e, z = F.col("p") * (1 - F.col("p")), F.col("y") - F.col("p"), F.col("z")
        a, b, c, g, h = held.withColumn("p", p).agg(F.sum(v), F.sum(v * z), F.sum(v * z * z), F.sum(e), F.sum(e * z)).first()
        step = np.linalg.solve(np.array([[a, b], [b, c]]) + np.diag(keep + 1e-9), np.array([g, h]) - keep * w)
        w += np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-7:
            break
    return w


def in_order(values: DataFrame, k: int, bins: int = 1024, few: int = 4096) -> float:
    """The exact value at place ``k`` (from 0) of a double column ``t``, by counts in ever smaller bins."""
    lo, hi, n = values.agg(F.min("t"), F.max("t"), F.count("t")).first()
    while n > few and lo < hi:
        values = values.where(F.col("t").between(lo, hi))
        at = F.least(F.floor((F.col("t") - F.lit(lo)) / F.lit(hi - lo) * bins), F.lit(bins - 1))
        for _, lo, hi, n in sorted(map(tuple, values.groupBy(at.alias("at")).agg(F.min("t"), F.max("t"), F.count("t")).collect())):
            if k < n:
                break
            k -= n
    return lo if lo == hi else sorted(r["t"] for r in values.where(F.col("t").between(lo, hi)).collect())[k]


def learn(docs: DataFrame) -> Model | None:
    """A model from all distinct windows."""
    c = materialise(sampled(docs).withColumn("h", F.xxhash64("window")), "secret-windows")
    held_out = F.pmod("h", F.lit(4)) == 0
    n = {(r["y"], r["held"]): r["n"] for r in c.groupBy("y", held_out.alias("held")).agg(F.count("*").alias("n")).collect()}
    if len({y for y, _ in n}) < 2:
        discard(c)
        return None
    net = trained(c.where(~held_out), {y: n.get((y, False), 0) for y in (0, 1)})

    def logits(batches):
        for x, y in chunks(batches):
            yield pa.RecordBatch.from_pydict({"y": y, "z": net.logits(x)})

    kept = sum(n.get((y, True), 0) for y in (0, 1))
    held = materialise(dealt(c.where(held_out), max(1, kept)).mapInArrow(logits, "y double, z double"), "secret-logits")
    rows, secret = held.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0.0))).first()
    scale = scaled(held) if 0 < secret < rows else np.array([0.0, 1.0])
    least = None
    if secret:
        t = held.where("y = 1").select((F.lit(float(scale[0])) + F.lit(float(scale[1])) * F.col("z")).alias("t"))
        least = in_order(t, int(secret * (1 - RECALL)))
    discard(held)
    discard(c)
    return Model.of(net, scale, least)


def judged(model: Model, ask: Iterator[tuple[int, str]], n: int) -> np.ndarray:
    """Of ``n`` candidates the largest probability of their windows; ask: (candidate, window)."""
    p = np.zeros(n)
    while some := list(islice(ask, AT_ONCE)):
        np.maximum.at(p, [i for i, _ in some], model.probability([w for _, w in some]))
    return p


def secrets(docs: DataFrame) -> DataFrame:
    """Per row: doc_id and spans, a list of (kind, a, b, p): base findings (p null) and what the network adds."""
    prepare(docs.sparkSession)
    model = learn(docs)
    rows = docs.select("doc_id", "text")

    def run(batches):
        for b in batches:
            texts = [t or "" for t in b.column("text").to_pylist()]
            base = [base_spans(t) for t in texts]
            other = [(r, *c) for r, t in enumerate(texts) for c in candidates(t, base[r])] if model else []
            p = judged(model, ((i, w) for i, (r, a, e) in enumerate(other) for w in windows(texts[r], a, e)), len(other)) if model else []
            found = [[(a, k, {"kind": KINDS[k], "a": a, "b": e, "p": None}) for k, a, e in spans] for spans in base]
            for (r, a, e), q in zip(other, p):
                if q >= model.threshold:
                    found[r].append((a, len(KINDS), {"kind": "model", "a": a, "b": e, "p": float(q)}))
            out = [[x for _, _, x in sorted(spans, key=lambda s: s[:2])] for spans in found]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(out, pa.list_(pa.struct([("kind", pa.string()), ("a", pa.int64()), ("b", pa.int64()), ("p", pa.float64())])))], names=["doc_id", "spans"])

    span = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("a", T.LongType()), T.StructField("b", T.LongType()), T.StructField("p", T.DoubleType())]))
    return rows.mapInArrow(run, T.StructType([rows.schema["doc_id"], T.StructField("spans", span)]))


def digest_columns(got: DataFrame) -> list:
    base = F.filter("spans", lambda s: s["kind"] != "model")
    def text(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["a"].cast("string"), s["b"].cast("string"))), ",")
    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return [*map(count, KINDS[:3]), F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans")]


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = secrets(table(spark, sf_dir, "documents"))
    return got.select("doc_id", *digest_columns(got))
