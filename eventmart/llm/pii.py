"""Personal data: fixed patterns, and a character-level BiLSTM-CRF that finds what is written otherwise.

The model reads windows of ``WINDOW`` characters around digits and ``@`` (nothing else can be part of a
span), ``STRIDE`` apart, so that every such character has a window with context on both sides.  A window is
decoded by Viterbi over the CRF's transitions.  Spans of all windows of a text are reconciled globally: a
span that touches the cut edge of its window is dropped, the rest compete by score, and the set of
disjoint spans with the greatest sum wins; fixed patterns go before the model's.

Labelled spans for training are those that the patterns find in a bounded sample of windows; a part of
them is rewritten (other separators, no plus sign) so that the model learns to read what the patterns miss.
"""

from __future__ import annotations

import heapq
import re
from bisect import bisect_right
from dataclasses import dataclass
from operator import itemgetter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import share

KINDS = ("email", "ip", "card", "phone")

# The patterns of the kinds.  An address is found from its @ (its local part is the run
# of such characters before it), which takes linear time on any text.
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TRIGGER = re.compile(r"[0-9@]")

WINDOW = 96
STRIDE = 48
#: Windows that the model learns from, at most.
TRAINING_WINDOWS = 1500
STEPS = 260
SEED = 11
#: Characters of a training window, and windows of a training step.
_CROP, _BATCH = 64, 48
_LETTERS = " \n.,-+()@/:;_%='\"0"
_SIZE, _HIDDEN = 12, 20
TAGS = 1 + 2 * len(KINDS)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the fixed patterns, by kind, then start."""
    if not _TRIGGER.search(text):
        return []
    found, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and _LOCAL.match(text[start - 1]):
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            found.append(("email", start, done))
        at = text.find("@", max(done, at + 1))
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m[0].split(".")]  # a part can have more digits than int() takes
        if all(len(p) <= 3 and int(p or "0") <= 255 for p in parts):
            found.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        own = _digits(m[0])
        if 16 <= len(own) <= 19 and luhn(own):
            found.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 8 <= len(_digits(m[0])) <= 15:
            found.append(("phone", *m.span()))
    return found


def _codes(text: str) -> np.ndarray:
    """Character classes: marks by themselves; digits, small, capital, other letters, anything else."""
    out = np.empty(len(text), np.int64)
    for i, c in enumerate(text):
        at = _LETTERS.find("0" if "0" <= c <= "9" else c)
        out[i] = at if at >= 0 else len(_LETTERS) + (0 if "a" <= c <= "z" else 1 if "A" <= c <= "Z" else 2 if c.isalpha() else 3)
    return out + 1


def windows_of(text: str, window: int = WINDOW, stride: int = STRIDE) -> list[tuple[int, int]]:
    """Stretches that cover every digit and @, each with context, in linear time."""
    out, last = [], -1
    for m in _TRIGGER.finditer(text):
        slot = m.start() // stride
        for own in (slot - 1, slot):
            if own > last and own >= 0 or (own == 0 and last < 0):
                start = max(0, own * stride)
                out.append((start, min(len(text), start + window)))
                last = own
    return out


def _lstm(x, w, u, b, keep=True):
    """Forward pass over (time, batch, size); returns states and, if ``keep``, what the backward pass needs."""
    steps, batch, _ = x.shape
    hidden = u.shape[0]
    h, c, kept = np.zeros((batch, hidden)), np.zeros((batch, hidden)), []
    states = np.zeros((steps, batch, hidden))
    projected = x @ w + b
    for t in range(steps):
        z = projected[t] + h @ u
        gates = 1 / (1 + np.exp(-z[:, : 3 * hidden]))
        i, f, o = gates[:, :hidden], gates[:, hidden : 2 * hidden], gates[:, 2 * hidden :]
        g = np.tanh(z[:, 3 * hidden :])
        before, c = c, f * c + i * g
        tanh_c = np.tanh(c)
        if keep:
            kept.append((h, before, i, f, o, g, tanh_c))
        h = o * tanh_c
        states[t] = h
    return states, kept


def _lstm_back(x, w, u, kept, grad):
    """Gradients of inputs and weights from those of the states."""
    dw, du, db, dx = np.zeros_like(w), np.zeros_like(u), np.zeros(w.shape[1]), np.zeros_like(x)
    dh_next = np.zeros_like(kept[0][0])
    dc_next = np.zeros_like(dh_next)
    for t in range(len(kept) - 1, -1, -1):
        h, before, i, f, o, g, tanh_c = kept[t]
        dh = grad[t] + dh_next
        dc = dc_next + dh * o * (1 - tanh_c**2)
        dz = np.concatenate(
            (dc * g * i * (1 - i), dc * before * f * (1 - f), dh * tanh_c * o * (1 - o), dc * i * (1 - g**2)), axis=1
        )
        dw += x[t].T @ dz
        du += h.T @ dz
        db += dz.sum(axis=0)
        dx[t], dh_next, dc_next = dz @ w.T, dz @ u.T, dc * f
    return dx, dw, du, db


@dataclass
class Tagger:
    """Embeddings, two LSTMs, a linear layer and CRF transitions."""

    p: dict[str, np.ndarray]

    @classmethod
    def fresh(cls, rng: np.random.Generator) -> Tagger:
        def near(*shape):
            return rng.normal(0, 1 / np.sqrt(shape[0]), shape)

        p = {"embed": rng.normal(0, 0.5, (len(_LETTERS) + 5, _SIZE)), "trans": np.zeros((TAGS, TAGS))}
        for inside in range(2, TAGS, 2):  # the rest of a span follows its own kind
            others = [t for t in range(TAGS) if t not in (inside - 1, inside)]
            p["trans"][others, inside] = -4
        for way in "fb":
            p |= {f"w{way}": near(_SIZE, 4 * _HIDDEN), f"u{way}": near(_HIDDEN, 4 * _HIDDEN), f"b{way}": np.zeros(4 * _HIDDEN)}
            p[f"b{way}"][_HIDDEN : 2 * _HIDDEN] = 1
        return cls(p | {"wo": near(2 * _HIDDEN, TAGS), "bo": np.zeros(TAGS)})

    def scores(self, codes: np.ndarray, keep: bool = True):
        """Tag scores (time, batch, tags) of windows (batch, time)."""
        p, x = self.p, self.p["embed"][codes.T]
        forward, kept_f = _lstm(x, p["wf"], p["uf"], p["bf"], keep)
        backward, kept_b = _lstm(x[::-1], p["wb"], p["ub"], p["bb"], keep)
        both = np.concatenate((forward, backward[::-1]), axis=2)
        return both @ p["wo"] + p["bo"], (x, kept_f, kept_b, both)

    def gradients(self, codes: np.ndarray, tags: np.ndarray, real: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Negative log likelihood per window and its gradients; ``real`` marks characters that are no padding."""
        p, (emit, (x, kept_f, kept_b, both)) = self.p, self.scores(codes)
        steps, batch, _ = emit.shape
        tags, real, rows = tags.T, real.T, np.arange(batch)
        alpha = np.zeros_like(emit)
        alpha[0] = emit[0]
        for t in range(1, steps):
            step = _logsum(alpha[t - 1][:, :, None] + p["trans"], 1) + emit[t]
            alpha[t] = np.where(real[t][:, None], step, alpha[t - 1])
        total = _logsum(alpha[-1], 1)
        beta, d_emit, d_trans = np.zeros((batch, TAGS)), np.zeros_like(emit), np.zeros((TAGS, TAGS))
        gold = emit[0, rows, tags[0]].copy()
        for t in range(steps - 1, -1, -1):
            on = real[t]
            d_emit[t] = np.exp(alpha[t] + beta - total[:, None]) * on[:, None]
            d_emit[t, rows, tags[t]] -= on
            if t:
                after = emit[t] + beta
                pair = np.exp(alpha[t - 1][:, :, None] + p["trans"] + after[:, None, :] - total[:, None, None])
                d_trans += (pair * on[:, None, None]).sum(axis=0)
                np.add.at(d_trans, (tags[t - 1][on], tags[t][on]), -1)
                gold += np.where(on, emit[t, rows, tags[t]] + p["trans"][tags[t - 1], tags[t]], 0)
                beta = np.where(on[:, None], _logsum(p["trans"] + after[:, None, :], 2), beta)
        d_both = d_emit @ p["wo"].T
        g = {"trans": d_trans, "wo": np.einsum("tbh,tbk->hk", both, d_emit), "bo": d_emit.sum(axis=(0, 1))}
        dx, g["wf"], g["uf"], g["bf"] = _lstm_back(x, p["wf"], p["uf"], kept_f, d_both[:, :, :_HIDDEN])
        dy, g["wb"], g["ub"], g["bb"] = _lstm_back(x[::-1], p["wb"], p["ub"], kept_b, d_both[::-1, :, _HIDDEN:])
        g["embed"] = np.zeros_like(p["embed"])
        np.add.at(g["embed"], codes.T, dx + dy[::-1])
        return float((total - gold).mean()), {k: v / batch for k, v in g.items()}

    def decode(self, codes: np.ndarray, real: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best tags (batch, time), and for each character by how much its tag beats "no data"."""
        emit, _ = self.scores(codes, keep=False)
        steps, batch, _ = emit.shape
        best, back, real = emit[0], np.zeros((steps, batch, TAGS), np.int64), real.T
        for t in range(1, steps):
            step = best[:, :, None] + self.p["trans"]
            back[t] = step.argmax(axis=1)
            on = real[t][:, None]
            back[t] = np.where(on, back[t], np.arange(TAGS))
            best = np.where(on, step.max(axis=1) + emit[t], best)
        tags, rows = np.zeros((steps, batch), np.int64), np.arange(batch)
        tags[-1] = best.argmax(axis=1)
        for t in range(steps - 1, 0, -1):
            tags[t - 1] = back[t, rows, tags[t]]
        margin = np.take_along_axis(emit, tags[:, :, None], 2)[:, :, 0] - emit[:, :, 0]
        return tags.T, margin.T


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (np.log(np.exp(x - top).sum(axis=axis, keepdims=True)) + top).squeeze(axis)


def _padded(texts: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    codes, real = np.zeros((len(texts), width), np.int64), np.zeros((len(texts), width), bool)
    for i, text in enumerate(texts):
        codes[i, : len(text)] = _codes(text)
        real[i, : len(text)] = True
    return codes, real


def _tags(length: int, spans: list[tuple[str, int, int]], width: int) -> np.ndarray:
    """B and I tags of spans; of spans that overlap the first counts."""
    tags = np.zeros(width, np.int64)
    for kind, start, end in spans:
        if not tags[start:end].any():
            k = KINDS.index(kind)
            tags[start:end] = 2 * k + 2
            tags[start] = 2 * k + 1
    return tags


def _varied(text: str, spans: list, rng: np.random.Generator) -> tuple[str, list]:
    """The same window with some spans written in ways that the patterns do not know."""
    out, moved, at = [], [], 0
    for kind, start, end in sorted(spans, key=lambda s: s[1]):
        if start < at:
            continue
        own = text[start:end]
        if rng.random() < 0.5:
            if kind == "card":
                mark = rng.choice([".", "/", "_", "  "])
                own = mark.join(_digits(own)[i : i + 4] for i in range(0, len(_digits(own)), 4))
            elif kind == "phone":
                own = own.lstrip("+").partition(" ")[2] if rng.random() < 0.5 and "(" in own else own.replace("+", "00", 1)
            elif kind == "email":
                own = own.replace("@", rng.choice([" @ ", "(@)", "@ "]))
        out += [text[at:start], own]
        began = sum(map(len, out)) - len(own)
        moved.append((kind, began, began + len(own)))
        at = end
    return "".join([*out, text[at:]]), moved


def train(docs: DataFrame, windows: int = TRAINING_WINDOWS, steps: int = STEPS, seed: int = SEED) -> Tagger | None:
    """Learn from at most ``windows`` windows of documents with a digit or @, chosen by a hash of the text.

    None if no document has any.
    """
    own = docs.filter(F.rlike("text", F.lit("[0-9@]"))).select("text", F.xxhash64("text").alias("h"))
    # hashes only are sorted, of distinct texts
    most = own.select("h").distinct().orderBy("h").limit(windows // 2).agg(F.max("h")).first()[0]
    sample = own.filter(F.col("h") <= F.lit(most)).dropDuplicates(["h"]).orderBy("h")
    rng, drawn = np.random.default_rng(seed), []
    for number, row in enumerate(sample.select("text").toLocalIterator()):
        spans, whole = base_spans(row["text"]), []
        for start, end in windows_of(row["text"], _CROP, _CROP // 2):
            inside = [(k, a - start, b - start) for k, a, b in spans if start <= a and b <= end]
            cut = any(a < end and b > start and not (start <= a and b <= end) for _, a, b in spans)
            if not cut:
                whole.append((xxhash.xxh64_intdigest(f"{number} {start}"), row["text"][start:end], inside))
        # a first window of every text, then a second one and so on; which, is a matter of its place's hash
        drawn += [(rank, number, *x[1:]) for rank, x in enumerate(heapq.nsmallest(2 * windows, whole, key=itemgetter(0)))]
        if len(drawn) > 8 * windows:
            drawn = heapq.nsmallest(2 * windows, drawn, key=itemgetter(0, 1))
    texts, labels = [], []
    for _, _, text, inside in sorted(drawn, key=itemgetter(0, 1)):
        text, own = _varied(text, inside, rng)
        if len(text) <= _CROP + 16 and len(texts) < windows:
            texts.append(text)
            labels.append(own)
    if not texts:
        return None
    width = _CROP + 16
    codes, real = _padded(texts, width)
    tags = np.stack([_tags(len(t), s, width) for t, s in zip(texts, labels, strict=True)])
    tagger = Tagger.fresh(rng)
    first, second = ({k: np.zeros_like(v) for k, v in tagger.p.items()} for _ in range(2))
    for step in range(1, steps + 1):
        own = rng.choice(len(texts), min(_BATCH, len(texts)), replace=False)
        longest = int(real[own].sum(axis=1).max())
        _, grads = tagger.gradients(codes[own, :longest], tags[own, :longest], real[own, :longest])
        for k, g in grads.items():
            g = np.clip(g, -5, 5)
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            rate = 0.03 * min(1, 2 * (1 - step / (steps + 1)))
            tagger.p[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
    return tagger


def _plausible(kind: str, text: str) -> bool:
    """What a span must have to be personal data at all, however it is written."""
    digits = len(_digits(text))
    if kind == "email":
        return "@" in text and "." in text.partition("@")[2] and text[0].isalnum() and text[-1].isalnum()
    if kind == "ip":
        return False
    if kind == "card":
        return 16 <= digits <= 19 and luhn(_digits(text)) and text[0].isdigit() and text[-1].isdigit()
    return 9 <= digits <= 15 and len(text) > digits and not any(c.isalpha() for c in text) and text[-1].isdigit()


def reconcile(candidates: list[tuple[float, str, int, int]]) -> list[tuple[str, int, int]]:
    """Of overlapping spans, the disjoint set with the greatest sum of scores, by start."""
    own = sorted(set(candidates), key=lambda c: (c[3], c[2]))
    ends, best, taken = [c[3] for c in own], [0.0], []
    for i, (score, _, start, _) in enumerate(own):
        before = bisect_right(ends, start, 0, i)
        take = best[before] + score > best[-1]
        best.append(best[before] + score if take else best[-1])
        taken.append((take, before))
    out, i = [], len(own)
    while i:
        take, before = taken[i - 1]
        if take:
            out.append(own[i - 1][1:])
        i = before if take else i - 1
    return out[::-1]


def model_spans(tagger: Tagger, texts: list[str], bases: list[list], batch: int = 128) -> list[list[tuple[str, int, int]]]:
    """Spans that the model adds to those of the patterns, per text."""
    jobs = [(i, a, b) for i, t in enumerate(texts) for a, b in windows_of(t)]
    candidates: list[list] = [[] for _ in texts]
    for at in range(0, len(jobs), batch):
        own = jobs[at : at + batch]
        codes, real = _padded([texts[i][a:b] for i, a, b in own], WINDOW)
        tags, margins = tagger.decode(codes, real)
        for (i, a, b), tag, margin in zip(own, tags, margins, strict=True):
            text, n, t = texts[i], b - a, 0
            while t < n:
                if tag[t] % 2 == 0:  # nothing, or the rest of what began before
                    t += 1
                    continue
                end = t + 1
                while end < n and tag[end] == tag[t] + 1:
                    end += 1
                cut = (t == 0 and a > 0) or (end == n and b < len(text))
                kind, score = KINDS[(tag[t] - 1) // 2], float(margin[t:end].mean())
                if not cut and score > 1 and _plausible(kind, text[a + t : a + end]):
                    candidates[i].append((score * (end - t), kind, a + t, a + end))
                t = end
    out = []
    for found, base in zip(candidates, bases, strict=True):
        starts = sorted((s, e) for _, s, e in base)
        reach = np.maximum.accumulate([e for _, e in starts]) if starts else []
        free = []
        for c in found:
            before = bisect_right(starts, (c[3] - 1, float("inf")))
            if not before or reach[before - 1] <= c[2]:
                free.append(c)
        out.append(reconcile(free))
    return out


def find_udf(spark, tagger: Tagger | None):
    """Column function: text to ``struct<base, spans>`` of (kind, start, end) arrays; null counts as empty."""
    shared = share(spark, tagger)

    @F.arrow_udf("base array<struct<kind:string,start:int,end:int>>, spans array<struct<kind:string,start:int,end:int>>")
    def find(column: pa.Array) -> pa.Array:
        texts = [t or "" for t in column.to_pylist()]
        bases = [base_spans(t) for t in texts]
        hot = [i for i, t in enumerate(texts) if _TRIGGER.search(t)]
        spans = list(bases)
        if hot and shared() is not None:
            for i, more in zip(hot, model_spans(shared(), [texts[i] for i in hot], [bases[i] for i in hot]), strict=True):
                spans[i] = sorted([*bases[i], *more], key=lambda s: (KINDS.index(s[0]), s[1]))
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        arrays = [pa.array([[dict(zip(("kind", "start", "end"), s, strict=True)) for s in x] for x in y], kind) for y in (bases, spans)]
        return pa.StructArray.from_arrays(arrays, names=["base", "spans"])

    return find


def find_pii(docs: DataFrame, tagger: Tagger | None) -> DataFrame:
    """For every row: doc_id, base, spans: arrays of (kind, start, end) by kind, then start.

    ``base`` holds the fixed patterns' spans, ``spans`` those and the model's.  Places are code points, ends
    exclusive.  A null or empty text has none.  Repeated rows stay, other columns are not looked at, texts are
    read whole; an empty table gives no rows.
    """
    found = docs.select("doc_id", find_udf(docs.sparkSession, tagger)("text").alias("r"))
    return found.select("doc_id", F.col("r.base").alias("base"), F.col("r.spans").alias("spans"))


def digest(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))))


def mask(docs: DataFrame, tagger: Tagger | None) -> DataFrame:
    """Documents with every span replaced by its kind in angle brackets; all columns, n_chars (if there) as of
    the new text.  Of spans that overlap, the one that starts first (or is longer) names the kind of both."""
    shared = share(docs.sparkSession, tagger)

    @F.arrow_udf("string")
    def masked(column: pa.Array) -> pa.Array:
        texts, out = column.to_pylist(), []
        plain = [t or "" for t in texts]
        bases = [base_spans(t) for t in plain]
        more = model_spans(shared(), plain, bases) if shared() is not None else [[] for _ in plain]
        for text, base, added in zip(texts, bases, more, strict=True):
            kept, at = [], 0
            for kind, start, end in sorted([*base, *added], key=lambda s: (s[1], -s[2])):
                if start >= at:
                    kept += [text[at:start], f"<{kind}>"]
                at = max(at, end)
            out.append("".join([*kept, text[at:]]) if kept else text)
        return pa.array(out, pa.string())

    found = docs.withColumn("__masked", masked("text"))
    changed = {"text": F.col("__masked")}
    if "n_chars" in docs.columns:
        own = F.when(F.col("__masked").eqNullSafe(F.col("text")), F.col("n_chars")).otherwise(F.length("__masked"))
        changed["n_chars"] = own.cast(docs.schema["n_chars"].dataType)
    return found.withColumns(changed).drop("__masked")
