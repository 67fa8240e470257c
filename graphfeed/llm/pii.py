"""Personal data in texts: base patterns, and a character BiLSTM with a CRF that adds to them.

The base finds e-mail addresses, network addresses, card and phone numbers by pattern. The
model is a bidirectional LSTM over characters with a linear-chain CRF, written in numpy and
trained from labelled spans: those of the base in a bounded sample of windows, half of them
rewritten (other separators, no leading plus sign) so that it learns shapes the patterns miss.

A text is cut into overlapping windows. Every span of the four kinds holds a digit or an at sign,
so only windows with one are decoded; others could give nothing. Spans decoded in all windows of a
text are reconciled over the whole text: runs cut by an inner window edge are joined with those of
their kind that they overlap in the next windows, so a span may be longer than a window, a candidate
must have what its kind needs (``plausible``) and touch no base span, and among candidates that
overlap the set of highest total confidence is taken.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import reduce
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphfeed.lineage import stored
from graphfeed.llm.common import hash_sample

KINDS = ["email", "ip", "card", "phone"]
WINDOW = 96
STRIDE = 48
SAMPLE = 600
EMBEDDING = 12
HIDDEN = 20
EPOCHS = 8
RATE = 0.01
BATCH = 512

# The base patterns. A digit run is only entered at its start, and an address is
# found from its at sign, which gives the same matches and stays linear in the text.
LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(\.[A-Za-z0-9-]++)+")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
TRIGGER = re.compile(r"[0-9@]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (2 if i % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def holds(kind: str, match: str) -> bool:
    """What a match of a base pattern must have besides its shape."""
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in match.split("."))
    if kind == "card":
        digits = _digits(match)
        return 12 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 9 <= len(_digits(match)) <= 15
    return True


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        match = DOMAIN.match(text, at) if start < at else None
        if match:
            yield start, match.end()
            done = match.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, rank of the kind, end) of the base, by start and then kind."""
    out = [(a, 0, b) for a, b in _emails(text)]
    for rank, pattern in ((1, IP), (2, CARD), (3, PHONE)):
        out += [(m.start(), rank, m.end()) for m in pattern.finditer(text)
                if holds(KINDS[rank], m.group())]
    return sorted(out)


def plausible(rank: int, text: str) -> bool:
    """What an added span must have: the base's checks, a little wider in shape."""
    digits = _digits(text)
    if rank == 0:
        return re.fullmatch(r"[^\s@]+ ?@ ?[^\s@]+ ?\. ?[^\s@.]+", text) is not None
    if rank == 1:
        parts = re.split(r" ?\. ?", text)
        return len(parts) == 4 and all(p.isascii() and p.isdigit() and len(p) <= 3 and int(p) < 256
                                       for p in parts)
    if rank == 2:
        return 12 <= len(digits) <= 19 and luhn(digits) and set(text) <= set("0123456789 -./")
    return 9 <= len(digits) <= 15 and set(text) <= set("+0123456789 -./()")


# tags: 0 outside, 2 r + 1 the first character of kind r, 2 r + 2 a later one
TAGS = 1 + 2 * len(KINDS)
# characters: 0 beyond the text, 1 to 95 printable ASCII, 96 line ends and tabs, 97 any other
CHARACTERS = 98


def characters(text: str) -> np.ndarray:
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    return np.where((code >= 32) & (code < 127), code - 31, np.where(code < 32, 96, 97))


def _rows(texts: list[str]) -> np.ndarray:
    out = np.zeros((len(texts), WINDOW), np.int64)
    for i, text in enumerate(texts):
        c = characters(text)
        out[i, :len(c)] = c
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


class Tagger:
    """Character embedding, an LSTM in each direction, a linear layer and CRF transitions."""

    def __init__(self, seed: int = 3) -> None:
        random = np.random.default_rng(seed)

        def start(*shape: int) -> np.ndarray:
            return (random.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

        self.p = {"embed": start(CHARACTERS, EMBEDDING) * 3, "out": start(2 * HIDDEN, TAGS),
                  "bias": np.zeros(TAGS, np.float32), "trans": np.zeros((TAGS, TAGS), np.float32),
                  "begin": np.zeros(TAGS, np.float32)}
        for d in "fb":
            self.p[f"x{d}"] = start(EMBEDDING, 4 * HIDDEN)
            self.p[f"h{d}"] = start(HIDDEN, 4 * HIDDEN)
            self.p[f"b{d}"] = np.zeros(4 * HIDDEN, np.float32)
            self.p[f"b{d}"][HIDDEN:2 * HIDDEN] = 1  # forget gates begin open

    def _forward(self, x: np.ndarray, d: str) -> tuple[np.ndarray, list]:
        """Hidden states of one direction, and what the way back needs."""
        p, steps = self.p, range(WINDOW) if d == "f" else range(WINDOW - 1, -1, -1)
        into = p["embed"][x] @ p[f"x{d}"] + p[f"b{d}"]
        h = c = np.zeros((len(x), HIDDEN), np.float32)
        out, kept = np.empty((len(x), WINDOW, HIDDEN), np.float32), []
        for t in steps:
            z = into[:, t] + h @ p[f"h{d}"]
            gates = _sigmoid(z[:, :3 * HIDDEN])
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN:2 * HIDDEN], gates[:, 2 * HIDDEN:]
            g = np.tanh(z[:, 3 * HIDDEN:])
            before, last = c, h
            c = f * c + i * g
            th = np.tanh(c)
            h = o * th
            out[:, t] = h
            kept.append((t, i, f, o, g, before, th, last))
        return out, kept

    def _backward(self, x: np.ndarray, d: str, kept: list, grad: np.ndarray, into: dict) -> None:
        p = self.p
        dh = dc = np.zeros((len(x), HIDDEN), np.float32)
        dz_all = np.empty((len(x), WINDOW, 4 * HIDDEN), np.float32)
        for t, i, f, o, g, before, th, last in reversed(kept):
            dh = dh + grad[:, t]
            dc = dc + dh * o * (1 - th * th)
            dz = np.hstack([dc * g * i * (1 - i), dc * before * f * (1 - f),
                            dh * th * o * (1 - o), dc * i * (1 - g * g)])
            into[f"h{d}"] += last.T @ dz
            dz_all[:, t] = dz
            dh, dc = dz @ p[f"h{d}"].T, dc * f
        flat = dz_all.reshape(-1, 4 * HIDDEN)
        seen = p["embed"][x].reshape(-1, EMBEDDING)
        into[f"x{d}"] += seen.T @ flat
        into[f"b{d}"] += flat.sum(0)
        np.add.at(into["embed"], x.ravel(), flat @ p[f"x{d}"].T)

    def emissions(self, x: np.ndarray) -> np.ndarray:
        states = np.concatenate([self._forward(x, d)[0] for d in "fb"], axis=2)
        return states @ self.p["out"] + self.p["bias"]

    def step(self, x: np.ndarray, tags: np.ndarray) -> tuple[float, dict]:
        """Loss (mean negative log-likelihood of the tag paths) and gradients."""
        p, n = self.p, len(x)
        grads = {k: np.zeros_like(v) for k, v in p.items()}
        hf, kf = self._forward(x, "f")
        hb, kb = self._forward(x, "b")
        states = np.concatenate([hf, hb], axis=2)
        e = states @ p["out"] + p["bias"]
        alpha = np.empty_like(e)
        alpha[:, 0] = p["begin"] + e[:, 0]
        for t in range(1, WINDOW):
            alpha[:, t] = _log_sum(alpha[:, t - 1, :, None] + p["trans"], 1) + e[:, t]
        beta = np.zeros_like(e)
        for t in range(WINDOW - 2, -1, -1):
            beta[:, t] = _log_sum(p["trans"] + (e[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
        whole = _log_sum(alpha[:, -1], 1)
        at = np.arange(n)[:, None], np.arange(WINDOW)[None], tags
        path = (e[at].sum(1) + p["begin"][tags[:, 0]] + p["trans"][tags[:, :-1], tags[:, 1:]].sum(1))
        marginal = np.exp(alpha + beta - whole[:, None, None])
        de = marginal.copy()
        de[at] -= 1
        de /= n
        for t in range(1, WINDOW):
            joint = np.exp(alpha[:, t - 1, :, None] + p["trans"] + (e[:, t] + beta[:, t])[:, None, :]
                           - whole[:, None, None])
            grads["trans"] += joint.sum(0) / n
        np.add.at(grads["trans"], (tags[:, :-1].ravel(), tags[:, 1:].ravel()), -1 / n)
        grads["begin"] += de[:, 0].sum(0)
        flat = de.reshape(-1, TAGS)
        grads["out"] += states.reshape(-1, 2 * HIDDEN).T @ flat
        grads["bias"] += flat.sum(0)
        dh = de @ p["out"].T
        self._backward(x, "f", kf, dh[:, :, :HIDDEN], grads)
        self._backward(x, "b", kb, dh[:, :, HIDDEN:], grads)
        return float((whole - path).mean()), grads

    def train(self, x: np.ndarray, tags: np.ndarray, epochs: int = EPOCHS, seed: int = 5) -> "Tagger":
        """Adam over shuffled batches."""
        random, turn = np.random.default_rng(seed), 0
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(w) for k, w in self.p.items()}
        for _ in range(epochs):
            for part in np.array_split(random.permutation(len(x)), max(1, len(x) // 48)):
                turn += 1
                _, grads = self.step(x[part], tags[part])
                for k, g in grads.items():
                    g = np.clip(g, -1, 1)
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.99 * v[k] + 0.01 * g * g
                    self.p[k] = (self.p[k] - RATE * (m[k] / (1 - 0.9**turn))
                                 / (np.sqrt(v[k] / (1 - 0.99**turn)) + 1e-8)).astype(np.float32)
        return self

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The best tag path of each window (Viterbi), and each character's chance of not being
        outside."""
        e, trans = self.emissions(x), self.p["trans"]
        score, back = self.p["begin"] + e[:, 0], np.empty((len(x), WINDOW, TAGS), np.int8)
        for t in range(1, WINDOW):
            ways = score[:, :, None] + trans
            back[:, t] = ways.argmax(1)
            score = ways.max(1) + e[:, t]
        tags = np.empty((len(x), WINDOW), np.int8)
        tags[:, -1] = score.argmax(1)
        rows = np.arange(len(x))
        for t in range(WINDOW - 1, 0, -1):
            tags[:, t - 1] = back[rows, t, tags[:, t]]
        shifted = np.exp(e - e.max(2, keepdims=True))
        return tags, 1 - shifted[:, :, 0] / shifted.sum(2)


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis))


def tags_of(length: int, spans: list[tuple[int, int, int]]) -> np.ndarray:
    """Tags of a window from its spans; where kinds overlap the first by start wins."""
    tags = np.zeros(WINDOW, np.int64)
    for start, rank, end in spans:
        end = min(end, length)
        if start < end and not tags[start:end].any():
            tags[start:end] = 2 * rank + 2
            tags[start] = 2 * rank + 1
    return tags


def rewritten(text: str, spans: list[tuple[int, int, int]], random: np.random.Generator
              ) -> tuple[str, list[tuple[int, int, int]]]:
    """The window with its spans in other shapes."""
    out, moved, at = [], [], 0
    for start, rank, end in spans:
        if start < at:
            continue
        was = text[start:end]
        if rank == 3:
            sep = random.choice([" ", "-", ".", "/"])
            was = re.sub(r"[ .-]+", sep, re.sub(r"^\+", "", was) if random.random() < 0.7 else was)
        elif rank == 2:
            digits, sep = _digits(was), random.choice(["", " ", "-", "."])
            was = sep.join(digits[i:i + 4] for i in range(0, len(digits), 4))
        elif rank == 1 and random.random() < 0.5:
            was = was.replace(".", " . ")
        elif rank == 0 and random.random() < 0.5:
            was = was.replace("@", " @ ", 1)
        out += [text[at:start], was]
        place = sum(map(len, out))
        moved.append((place - len(was), rank, place))
        at = end
    return "".join([*out, text[at:]])[:WINDOW], [s for s in moved if s[0] < WINDOW]


def trained(windows: list[str], seed: int = 13) -> Tagger:
    """A tagger for the base's spans of the windows, half of which are also shown rewritten."""
    random, texts, tags = np.random.default_rng(seed), [], []
    for i, text in enumerate(windows):
        spans = base_spans(text)
        texts.append(text)
        tags.append(tags_of(len(text), spans))
        if spans and i % 2 == 0:
            text, spans = rewritten(text, spans, random)
            texts.append(text)
            tags.append(tags_of(len(text), spans))
    tagger = Tagger()
    return tagger.train(_rows(texts), np.array(tags)) if texts else tagger


def regions(text: str) -> list[tuple[int, str]]:
    """(start, text) of the runs of windows that hold a digit or an at sign."""
    out: list[list[int]] = []
    last = max(0, -(-(len(text) - WINDOW) // STRIDE))  # the last window reaches the end
    for m in TRIGGER.finditer(text):
        at = m.start()
        low = max(0, -(-(at - WINDOW + 1) // STRIDE)) * STRIDE
        high = min(at // STRIDE, last) * STRIDE + WINDOW
        if out and low <= out[-1][1]:
            out[-1][1] = max(out[-1][1], high)
        else:
            out.append([low, high])
    return [(a, text[a:b]) for a, b in out]


def cut(region: tuple[int, str]) -> list[tuple[int, str]]:
    start, text = region
    count = max(1, -(-(len(text) - WINDOW) // STRIDE) + 1)
    return [(start + i * STRIDE, text[i * STRIDE:i * STRIDE + WINDOW]) for i in range(count)]


def spans_of(tags: np.ndarray, chance: np.ndarray, length: int) -> list[tuple[int, int, int, float]]:
    """(start, rank, end, confidence) of the tagged runs of a window."""
    out, at = [], 0
    while at < length:
        tag = int(tags[at])
        if tag == 0:
            at += 1
            continue
        rank, end = (tag - 1) // 2, at + 1
        while end < length and tags[end] == 2 * rank + 2:
            end += 1
        out.append((at, rank, end, float(chance[at:end].sum())))
        at = end
    return out


def joined(pieces: list[tuple[int, int, int, float, bool, bool]]
           ) -> list[tuple[int, int, int, float]]:
    """(start, rank, end, confidence) of the whole runs, and of cut ones that others complete.

    A piece is a run of one window with whether the window's edge cuts it before and after. Pieces
    of a kind that overlap are joined if one is cut; both ends of the whole must be uncut. Its
    confidence is per character that of its pieces.
    """
    out = [p[:4] for p in pieces if not p[4] and not p[5]]
    for rank in {p[1] for p in pieces if p[4] or p[5]}:
        mine = sorted(p for p in pieces if p[1] == rank)
        at = 0
        while at < len(mine):
            start, end, after = mine[at][0], mine[at][2], at + 1
            while after < len(mine) and mine[after][0] < end:
                end, after = max(end, mine[after][2]), after + 1
            group, at = mine[at:after], after
            if (any(p[4] or p[5] for p in group) and any(p[0] == start and not p[4] for p in group)
                    and any(p[2] == end and not p[5] for p in group)):
                share = sum(p[3] for p in group) / sum(p[2] - p[0] for p in group)
                out.append((start, rank, end, share * (end - start)))
    return out


def reconciled(found: list[tuple[int, int, int, float]], base: list[tuple[int, int, int]]
               ) -> list[tuple[int, int, int]]:
    """The set of candidates of highest total confidence that touch neither each other nor the base."""
    best: dict[tuple[int, int, int], float] = {}
    base = sorted(base)
    starts, reach = [b[0] for b in base], [0, *accumulate((b[2] for b in base), max)]
    for start, rank, end, score in found:
        if reach[bisect_left(starts, end)] <= start:  # no base span begins before its end and passes its start
            best[start, rank, end] = max(score, best.get((start, rank, end), 0.0))
    spans = sorted(best, key=lambda s: (s[2], s))
    ends, total, taken = [s[2] for s in spans], [0.0], [None]
    for i, span in enumerate(spans):
        before = bisect_right(ends, span[0], 0, i)
        with_it = total[before] + best[span]
        total.append(max(total[i], with_it))
        taken.append((span, before) if with_it > total[i] else None)
    out, i = [], len(spans)
    while i > 0:
        if taken[i]:
            out.append(taken[i][0])
            i = taken[i][1]
        else:
            i -= 1
    return sorted(out)


SPAN = pa.struct([("start", pa.int32()), ("rank", pa.int32()), ("end", pa.int32())])
REGION = pa.struct([("start", pa.int32()), ("text", pa.string())])


def scanned(docs: DataFrame, doc_id: Column, text: Column) -> DataFrame:
    """(_id, base, regions, n_chars) of every row: base spans, and what the model has to read."""
    schema = pa.schema([("_id", pa.int64()), ("base", pa.list_(SPAN)), ("regions", pa.list_(REGION)),
                        ("n_chars", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, parts, sizes = [], [], []
            for value in batch["_text"]:
                body = value.as_py() or ""
                some = TRIGGER.search(body) is not None
                base.append([dict(zip(("start", "rank", "end"), s, strict=True))
                             for s in base_spans(body)] if some else [])
                parts.append([{"start": a, "text": t} for a, t in regions(body)] if some else [])
                sizes.append(len(body))
            yield pa.RecordBatch.from_arrays(
                [batch["_id"], pa.array(base, pa.list_(SPAN)), pa.array(parts, pa.list_(REGION)),
                 pa.array(sizes, pa.int64())], schema=schema)

    return docs.select(doc_id.cast("long").alias("_id"), text.cast("string").alias("_text")).mapInArrow(
        run, "_id long, base array<struct<start:int,rank:int,end:int>>, "
             "regions array<struct<start:int,text:string>>, n_chars long")


def training_windows(scans: DataFrame, sample: int = SAMPLE) -> list[str]:
    """About ``sample`` window texts that hold base spans, as many of each kind, and half as many
    that hold none.

    Those with the smallest hashes, so the same on every run; equal texts count once.
    """
    start = F.col("r.start")
    size = F.length("r.text")
    each = scans.filter(F.size("regions") > 0).select("base", F.explode("regions").alias("r"))
    each = each.select("base", start.alias("a"), "r.text", F.explode(F.sequence(
        F.lit(0), F.greatest(F.ceil((size - WINDOW) / STRIDE), F.lit(0)).cast("int"))).alias("i"))
    low = F.col("a") + F.col("i") * STRIDE
    inside = F.filter("base", lambda s: (s["start"] >= low) & (s["end"] <= low + WINDOW))
    each = each.select(
        F.substring("text", F.col("i") * STRIDE + 1, F.lit(WINDOW)).alias("text"),
        F.transform(inside, lambda s: s["rank"]).alias("ranks"))
    sorts = [(F.array_contains("ranks", rank), sample // len(KINDS)) for rank in range(len(KINDS))]
    sorts.append((F.size("ranks") == 0, sample // 2))
    counts = each.agg(*[F.approx_count_distinct(F.when(has, F.col("text"))).alias(f"n{i}")
                        for i, (has, _) in enumerate(sorts)]).first()
    picked = [hash_sample(each.filter(has).select("text"), "text", many, count)
              for (has, many), count in zip(sorts, counts, strict=True)]
    return sorted(r["text"] for r in reduce(DataFrame.unionByName, picked).distinct().collect())


def found(docs: DataFrame, doc_id: Column, text: Column, sample: int = SAMPLE) -> DataFrame:
    """Per row of ``docs``: _id, base and spans (base and added), each (start, rank, end).

    Places are code points, ends exclusive. Null and empty texts have none. Repeated rows and null
    ids each give a row. Without a single window to learn from nothing is added.
    """
    scans = stored(scanned(docs, doc_id, text), "pii-scans")
    windows = training_windows(scans, sample)
    tagger = trained(windows) if any(base_spans(w) for w in windows) else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch["base"].to_pylist()
            pieces = [[] for _ in rows]
            for row, piece in _decoded(batch, tagger) if tagger else ():
                pieces[row].append(piece)
            added = [_candidates(mine, batch["regions"][row].as_py()) if mine else []
                     for row, mine in enumerate(pieces)]
            base = [[(s["start"], s["rank"], s["end"]) for s in row] for row in rows]
            every = [sorted(known + reconciled(more, known)) for known, more in
                     zip(base, added, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch["_id"], batch["base"], pa.array(
                    [[dict(zip(("start", "rank", "end"), s, strict=True)) for s in row]
                     for row in every], pa.list_(SPAN))], names=["_id", "base", "spans"])

    return scans.mapInArrow(run, "_id long, base array<struct<start:int,rank:int,end:int>>, "
                                 "spans array<struct<start:int,rank:int,end:int>>")


def _candidates(pieces: list, parts: list[dict]) -> list[tuple[int, int, int, float]]:
    """The joined runs of a text that have what their kind needs; a run lies within one region."""
    starts, out = [p["start"] for p in parts], []
    for start, rank, end, score in joined(pieces):
        part = parts[bisect_right(starts, start) - 1]
        if plausible(rank, part["text"][start - part["start"]:end - part["start"]]):
            out.append((start, rank, end, score))
    return out


def _decoded(batch: pa.RecordBatch, tagger: Tagger) -> Iterator[tuple[int, tuple]]:
    """(row, piece) of every run in every window, see ``joined``."""
    def windows() -> Iterator[tuple[int, int, str, int]]:
        sizes = batch["n_chars"].to_pylist()
        for row, parts in enumerate(batch["regions"]):
            for part in parts:
                for start, text in cut((part["start"].as_py(), part["text"].as_py())):
                    yield row, start, text, sizes[row]

    held: list[tuple[int, int, str, int]] = []

    def flush() -> Iterator[tuple[int, tuple]]:
        tags, chance = tagger.decode(_rows([w[2] for w in held]))
        for (row, start, text, size), t, c in zip(held, tags, chance, strict=True):
            last = start + len(text) == size
            for a, rank, b, score in spans_of(t, c, len(text)):
                yield row, (start + a, rank, start + b, score, a == 0 < start, b == len(text) and not last)

    for window in windows():
        held.append(window)
        if len(held) == BATCH:
            yield from flush()
            held = []
    if held:
        yield from flush()
