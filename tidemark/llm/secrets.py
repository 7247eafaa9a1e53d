"""Secret scans: fixed rules, and a character convolutional network over every other candidate.

Rules (``assign``, ``access``, ``hex``) give the base findings. Candidates are runs of
A-Z a-z 0-9 + / _ = -: those of 16 or more characters, and those of 6 or more that stand behind a colon,
an equals sign (spaces and a quote may lie between) or a quote, or that hold an equals sign with 6
characters behind it. Where a finding of the rules covers part of a run, the parts beside it that
have 16 characters are candidates of their own. The network
sees a candidate in windows of VALUE characters, one every STRIDE characters and one at its end, with BEFORE
characters ahead of the window and AFTER behind it, and the highest score is the candidate's: character embeddings with a mark for the candidate, one convolution,
maxima over the candidate and over its surroundings, and a logistic output.

It is trained on labelled findings, on all of them: candidates that a rule has found are
positive, the others negative, and as many again of the positive ones have value and key word exchanged
for others of common make, so that it learns more than the rules say. Contexts are dealt by hash over shards of about SHARD of a
kind; the kind that has fewer goes into as many shards as give each LESSER of it, or into all. Every shard
trains from the same weights, a Spark task each, and the weights and Adam's moments are averaged over the shards, ROUNDS times; a single
shard is trained in one go. A quarter is held out, by hash: all of it is scored in tasks, which count the outputs in steps of 1 / GRAIN.
Platt scaling calibrates on these counts, and the threshold lies halfway between the highest score that
keeps ``recall`` of the held-out positives and the score that 95 % of the negatives stay under. Candidates above it that no rule
covers are added as ``network`` findings. A secret that no rule knows is labelled negative, so a
candidate is judged by a network that has not seen it: there are two, each trained on one
half of the candidates for the other half. Where such secrets are many (a tenth of the negatives), they teach
that they are none. With fewer than LEAST labels of either kind in a half nothing is added.

The scan is one pass without a shuffle; candidates with their context are stored,
and training and scoring read that table. The driver holds two networks and their counts, whatever the number of candidates.

Nulls: a null text is empty. Positions are code points of the text as it is.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.files import task_each
from tidemark.llm.words import LOWER, find_words, text_chunks
from tidemark.llm.shared import by_value
from tidemark.sources.durable import checkpoint

# The base rules.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24
KINDS = ("assign", "access", "hex", "network")

CANDIDATE_LEAST, ASSIGNED_LEAST = 16, 6
BEFORE, VALUE, AFTER = 32, 48, 16
STRIDE = 24
WIDTH = BEFORE + VALUE + AFTER
LEAST, RECALL = 20, 0.97
UNDER = 0.95
EPOCHS, STEPS, VARIED, FEW = 12, 400, 4, 500
SHARD, LESSER, ROUNDS = 4096, 512, 6
HELD, SALTS, GRAIN, HIGHEST = 4, 16, 256, 64
_MARKS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key", b"akia")


def _class(characters: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(characters)] = True
    return table


_HEX = _class(b"0123456789abcdef")
_QUOTE, _SIGN = _class(b"\"'`"), _class(b":=")
_VALUE = _class(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-")

_SPAN = pa.struct([("kind", pa.int8()), ("start", pa.int32()), ("end", pa.int32())])
_CANDIDATE = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()), ("side", pa.int8()), ("contexts", pa.list_(pa.string()))])
SCANNED = (
    "doc_id bigint, spans array<struct<kind:tinyint,start:int,end:int>>, "
    "candidates array<struct<start:int,end:int,base:boolean,side:tinyint,contexts:array<string>>>")


def context_of(text: str, start: int, end: int) -> str:
    """BEFORE characters, VALUE of the candidate and AFTER behind it, each padded with NUL."""
    value = text[start:min(end, start + VALUE)].ljust(VALUE, "\0")
    return text[max(0, start - BEFORE):start].rjust(BEFORE, "\0") + value + text[end:end + AFTER].ljust(AFTER, "\0")


def windows_of(start: int, end: int) -> list[tuple[int, int]]:
    """Overlapping windows of VALUE characters that cover the candidate; a short one is its own window."""
    last = max(start, end - VALUE)
    return [(at, min(end, at + VALUE)) for at in [*range(start, last, STRIDE), last]]


def assigned(data: np.ndarray, offsets: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether each run stands behind a sign or a quote, or holds an equals sign with ASSIGNED_LEAST characters behind it."""
    if not len(starts):
        return np.zeros(0, bool)
    begin = offsets[np.searchsorted(offsets, starts, "right") - 1]
    solid = np.maximum.accumulate(np.where(data != 0x20, np.arange(len(data)), -1))
    quoted = (starts > begin) & _QUOTE[data[starts - 1]]
    before = starts - quoted
    at = np.where(before > begin, solid[before - 1], -1)
    signed = (at >= begin) & _SIGN[data[at]]
    equals = np.concatenate([[0], np.cumsum(data == 0x3D)])
    return quoted | signed | (equals[np.maximum(ends - ASSIGNED_LEAST, starts + 1)] > equals[starts + 1])


def pieces(start: int, end: int, spans: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, bool]]:
    """The parts of a run that the rules' spans cover, and those beside them that are long enough; a free run as it is."""
    found = sorted((max(s, start), min(e, end)) for s, _, e in spans if s < end and start < e)
    if not found:
        yield start, end, False
        return
    merged = [found[0]]
    for s, e in found[1:]:
        if s <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(e, merged[-1][1]))
        else:
            merged.append((s, e))
    for s, e in merged:
        if e - s >= ASSIGNED_LEAST:
            yield s, e, True
    for (_, s), (e, _) in zip([(start, start), *merged], [*merged, (end, end)]):
        if e - s >= CANDIDATE_LEAST:
            yield s, e, False


def scan_documents(documents: DataFrame) -> DataFrame:
    """Per document: doc_id, the rules' spans, and all candidates with their context."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        assign, access = re.compile(ASSIGN, re.IGNORECASE | re.ASCII), re.compile(ACCESS)
        marks = re.compile(b"|".join(_MARKS))
        for batch in batches:
            for i, j, data, offsets in text_chunks(batch.column(1)):
                raw = data.tobytes()
                lengths = np.cumsum(np.concatenate([[0], (data & 0xC0) != 0x80]))  # code points before each byte
                spans, candidates = [[] for _ in range(i, j)], [[] for _ in range(i, j)]
                texts: dict[int, str] = {}

                def text_of(t: int) -> str:
                    if t not in texts:
                        texts[t] = raw[offsets[t]:offsets[t + 1]].decode()
                    return texts[t]

                def placed(starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, int, int]]:
                    of = np.searchsorted(offsets, starts, "right") - 1
                    base = lengths[offsets[of]]
                    return zip(of.tolist(), (lengths[starts] - base).tolist(), (lengths[ends] - base).tolist())

                marked = np.array([m.start() for m in marks.finditer(LOWER[data].tobytes())], np.int64)
                for t in np.unique(np.searchsorted(offsets, marked, "right") - 1).tolist():
                    for m in assign.finditer(text_of(t)):
                        if len(m[2]) >= ASSIGN_LEAST:
                            spans[t].append((m.start(), 0, m.end()))
                    for m in access.finditer(text_of(t)):
                        if m.end() - m.start() >= ACCESS_LEAST:
                            spans[t].append((m.start(), 1, m.end()))
                starts, ends, _ = find_words(data, offsets, _HEX)
                long = ends - starts >= HEX_LEAST
                for t, a, b in placed(starts[long], ends[long]):
                    spans[t].append((a, 2, b))
                starts, ends, _ = find_words(data, offsets, _VALUE)
                taken = (ends - starts >= CANDIDATE_LEAST) | (ends - starts >= ASSIGNED_LEAST) & assigned(data, offsets, starts, ends)
                for t, a, b in placed(starts[taken], ends[taken]):
                    for start, end, found in pieces(a, b, spans[t]):
                        windows = windows_of(start, end)
                        contexts = [context_of(text_of(t), *w) for w in windows]
                        candidates[t].append({"start": start, "end": end, "base": found, "side": side_of(contexts[0]), "contexts": contexts})
                rows = [[{"kind": k, "start": s, "end": e} for s, k, e in sorted(own)] for own in spans]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(rows, pa.list_(_SPAN)), pa.array(candidates, pa.list_(_CANDIDATE))],
                    ["doc_id", "spans", "candidates"])

    docs = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(scan, SCANNED)


def encode(contexts: list[str]) -> np.ndarray:
    """Character numbers: printable ASCII each its own, 0 for padding, 1 for white space, 2 for all others."""
    codes = np.frombuffer("".join(contexts).encode("utf-32-le"), "<u4").astype(np.int64).reshape(len(contexts), WIDTH)
    out = np.where((codes > 0x20) & (codes < 0x7F), codes - 0x1E, 2)
    out[codes == 0] = 0
    out[(codes == 0x20) | ((codes >= 9) & (codes <= 13))] = 1
    return out.astype(np.uint8)


@dataclass
class Network:
    """Weights, the Platt scaling of the output, and the threshold on the calibrated score."""

    embed: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray
    scale: tuple[float, float] = (1.0, 0.0)
    threshold: float = 0.5

    FILTER = 5

    def _forward(self, codes: np.ndarray):
        inside = np.zeros((1, WIDTH, 1))
        inside[:, BEFORE:BEFORE + VALUE] = 1
        x = np.concatenate([self.embed[codes], np.broadcast_to(inside, (len(codes), WIDTH, 1))], axis=2)
        padded = np.pad(x, ((0, 0), (self.FILTER // 2, self.FILTER // 2), (0, 0)))
        windows = np.lib.stride_tricks.sliding_window_view(padded, self.FILTER, axis=1).transpose(0, 1, 3, 2)
        flat = windows.reshape(len(codes), WIDTH, -1)
        hidden = np.maximum(flat @ self.filters + self.bias, 0)
        value, around = hidden[:, BEFORE:BEFORE + VALUE], np.concatenate([hidden[:, :BEFORE], hidden[:, BEFORE + VALUE:]], axis=1)
        a, b = value.argmax(axis=1), around.argmax(axis=1)
        pooled = np.concatenate([np.take_along_axis(value, a[:, None], 1)[:, 0], np.take_along_axis(around, b[:, None], 1)[:, 0]], axis=1)
        return flat, a, b, pooled, pooled @ self.out + self.out_bias[0]

    def outputs(self, contexts: list[str]) -> np.ndarray:
        """What the last layer gives, before calibration."""
        return np.concatenate([np.zeros(0), *(self._forward(encode(contexts[at:at + 256]))[-1] for at in range(0, len(contexts), 256))])

    def scores(self, contexts: list[str]) -> np.ndarray:
        """Calibrated probabilities."""
        return 1 / (1 + np.exp(-np.clip(self.scale[0] * self.outputs(contexts) + self.scale[1], -60, 60)))


class Training:
    """A network and the state of Adam."""

    def __init__(self, rng: np.random.Generator, channels: int = 24, width: int = 12):
        f = Network.FILTER * (width + 1)
        self.net = Network(
            rng.normal(0, 0.3, (97, width)), rng.normal(0, f**-0.5, (f, channels)), np.zeros(channels), rng.normal(0, 0.2, 2 * channels), np.zeros(1))
        self.parts = [self.net.embed, self.net.filters, self.net.bias, self.net.out, self.net.out_bias]
        self.m, self.v = [np.zeros_like(p) for p in self.parts], [np.zeros_like(p) for p in self.parts]
        self.step = 0.0

    def values(self) -> np.ndarray:
        """All weights, both moments and the number of steps in one row."""
        return np.concatenate([*(p.ravel() for p in (*self.parts, *self.m, *self.v)), [self.step]])

    def put(self, values: np.ndarray) -> None:
        at = 0
        for p in (*self.parts, *self.m, *self.v):
            p[...] = values[at:at + p.size].reshape(p.shape)
            at += p.size
        self.step = float(values[at])

    def run(self, contexts: list[str], labels: np.ndarray, rounds: int, size: int, rng: np.random.Generator) -> None:
        """Adam on the logistic loss, both kinds weighing the same."""
        net = self.net
        f, channels = net.filters.shape
        width = net.embed.shape[1]
        codes = encode(contexts)
        weight = np.where(labels == 1, 0.5 / max(labels.mean(), 1e-6), 0.5 / max(1 - labels.mean(), 1e-6))
        for _ in range(rounds):
            order = rng.permutation(len(codes))
            for at in range(0, len(order), size):
                rows = order[at:at + size]
                n, own = len(rows), codes[rows]
                flat, a, b, pooled, z = net._forward(own)
                dz = (1 / (1 + np.exp(-np.clip(z, -60, 60))) - labels[rows]) * weight[rows] / n
                dpool = dz[:, None] * net.out[None, :] * (pooled > 0)
                dhidden = np.zeros((n, WIDTH, channels))
                row, col = np.arange(n)[:, None], np.arange(channels)[None, :]
                dhidden[row, BEFORE + a, col] += dpool[:, :channels]
                dhidden[row, np.where(b < BEFORE, b, b + VALUE), col] += dpool[:, channels:]
                dflat = (dhidden.reshape(-1, channels) @ net.filters.T).reshape(n, WIDTH, Network.FILTER, width + 1)
                dx = np.zeros((n, WIDTH + Network.FILTER - 1, width))
                for k in range(Network.FILTER):
                    dx[:, k:k + WIDTH] += dflat[:, :, k, :width]
                dembed = np.zeros_like(net.embed)
                np.add.at(dembed, own, dx[:, Network.FILTER // 2:Network.FILTER // 2 + WIDTH])
                grads = [dembed, flat.reshape(-1, f).T @ dhidden.reshape(-1, channels), dhidden.sum(axis=(0, 1)), pooled.T @ dz, np.array([dz.sum()])]
                self.step += 1
                for p, g, mm, vv in zip(self.parts, grads, self.m, self.v):
                    mm *= 0.9
                    mm += 0.1 * g
                    vv *= 0.999
                    vv += 0.001 * g * g
                    p -= 3e-3 * (mm / (1 - 0.9**self.step)) / (np.sqrt(vv / (1 - 0.999**self.step)) + 1e-8)


def epochs_of(n: int, rounds: int = EPOCHS, size: int = 64) -> int:
    """Few labels are gone through more often."""
    return max(rounds, -(-STEPS * size // n))


def train_network(contexts: list[str], labels: np.ndarray, rounds: int = EPOCHS, size: int = 64, channels: int = 24, width: int = 12) -> Network:
    """One network, trained here."""
    rng = np.random.Generator(np.random.PCG64(7))
    training = Training(rng, channels, width)
    training.run(contexts, labels, epochs_of(len(contexts), rounds, size), size, rng)
    return training.net


def calibrate(net: Network, contexts: list[str], labels: np.ndarray, recall: float) -> None:
    """:func:`calibrate_counts` for labelled contexts."""
    calibrate_counts(net, net.outputs(contexts), labels == 1, np.ones(len(contexts), np.int64), recall)


def ranked(values: np.ndarray, n: np.ndarray, share: float) -> float:
    """The quantile of ``values`` that occur ``n`` times each."""
    order = np.argsort(values)
    values, upto = values[order], np.cumsum(n[order])
    at = (upto[-1] - 1) * share
    low, high = (values[np.searchsorted(upto, k, "right")] for k in (int(np.floor(at)), int(np.ceil(at))))
    return float(low + (high - low) * (at - np.floor(at)))


def calibrate_counts(net: Network, z: np.ndarray, positive: np.ndarray, n: np.ndarray, recall: float) -> None:
    """Platt scaling on held-out outputs ``z`` that occur ``n`` times each, and a threshold that keeps ``recall`` of the positives: halfway down to what UNDER of the negatives stay under."""
    # Platt's targets keep the scores off 0 and 1.
    target = np.where(positive, (n[positive].sum() + 1) / (n[positive].sum() + 2), 1 / (n[~positive].sum() + 2))
    a, b = 1.0, 0.0
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -60, 60)))
        w = n * np.maximum(p * (1 - p), 1e-6)
        slope = np.array([(n * (p - target) * z).sum() + 1e-3 * (a - 1), (n * (p - target)).sum()])
        curve = np.array([[(w * z * z).sum() + 1e-3, (w * z).sum()], [(w * z).sum(), w.sum() + 1e-6]])
        move = np.linalg.solve(curve, slope)
        move = np.clip(move, -1, 1)
        a, b = a - move[0], b - move[1]
        if np.abs(move).max() < 1e-8:
            break
    net.scale = (float(a), float(b))
    scores = 1 / (1 + np.exp(-np.clip(a * z + b, -60, 60)))
    order = np.argsort(scores[positive])
    lost = int(np.floor((1 - recall) * n[positive].sum()))
    limit = scores[positive][order][np.searchsorted(np.cumsum(n[positive][order]), lost, "right")]
    # A few negatives are secrets that no rule knows, so the highest ones do not count.
    net.threshold = float(limit + min(limit, ranked(scores[~positive], n[~positive], UNDER))) / 2


_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
_KEYS = ("credential", "auth", "private_key", "client-key", "bearer", "access_key", "pwd", "signing key")


def varied(contexts: list[str]) -> list[str]:
    """The positive contexts with another key word and another value of common make, some at the end of a longer run."""
    out, seen = [], Counter()
    for context in contexts:
        # Each context by itself, so that it does not matter which others are in the same task.
        rng = np.random.Generator(np.random.PCG64([11, zlib.crc32(context.encode()), seen[context]]))
        seen[context] += 1
        alphabet = (_LETTERS, _LETTERS + "+/", _LETTERS[:26] + _LETTERS[52:], _LETTERS + "_-")[rng.integers(4)]
        value = "".join(alphabet[k] for k in rng.integers(0, len(alphabet), int(rng.integers(8, VALUE))))
        before = context[:BEFORE]
        if rng.random() < 0.5:
            # As full of text as others, so that padding does not tell the made ones.
            lead = before.lstrip("\0")
            lead = lead[12:] + lead[:20] + " " + _KEYS[rng.integers(len(_KEYS))] + ("=", ": ", ' = "')[rng.integers(3)]
            before = lead[-BEFORE:].rjust(BEFORE, "\0")
        behind = context[BEFORE + VALUE:]
        if rng.random() < 0.4:
            # A window of a longer candidate: the value stands behind its key word and other text of the same run.
            pieces = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "abcdefghijklmnopqrstuvwxyz0123456789-")[rng.integers(3)]
            lead = "".join("/" if rng.random() < 0.08 else pieces[k] for k in rng.integers(0, len(pieces), 2 * VALUE))
            tail = "/" + _KEYS[rng.integers(len(_KEYS))].replace(" ", "_") + "=" + value[:8 + int(rng.integers(24))]
            whole = (lead + tail)[-(BEFORE + VALUE):]
            before, value = whole[:BEFORE], whole[BEFORE:]
        out.append(before + value.ljust(VALUE, "\0") + behind)
    return out


def side_of(context: str) -> int:
    """Which of the two networks has not seen the candidate in training."""
    return zlib.crc32(context.encode()) & 1


def _held(salt: int) -> Column:
    return F.pmod(F.xxhash64("context", F.lit(salt)), F.lit(HELD)) == 0


def _per_net(values: list) -> Column:
    return F.when(F.col("net") == 0, values[0]).otherwise(values[1])


def deal_shards(labels: DataFrame, fit: dict[tuple[int, bool], int]) -> DataFrame:
    """Rows (net, shard, good, bad): ``labels`` (net, base, context), of which there are ``fit`` for each net and kind, over shards."""
    shards = [-(-max(fit[net, True], fit[net, False]) // SHARD) for net in (0, 1)]
    copies = [{kind: min(shards[net], -(-shards[net] * LESSER // fit[net, kind])) for kind in (True, False)} for net in (0, 1)]
    last = F.when(F.col("base"), _per_net([F.lit(c[True] - 1) for c in copies])).otherwise(_per_net([F.lit(c[False] - 1) for c in copies]))
    n = _per_net([F.lit(k) for k in shards])
    first = F.pmod(F.xxhash64("context", F.lit(-1)), n)
    dealt = labels.select("net", "base", "context", n.alias("_n"), first.alias("_first"), F.explode(F.sequence(F.lit(0), last)).alias("_copy"))
    kind = lambda base: F.array_sort(F.collect_list(F.when(F.col("base") == base, F.col("context"))))
    return dealt.groupBy("net", F.pmod(F.col("_first") + F.col("_copy"), F.col("_n")).alias("shard")).agg(kind(True).alias("good"), kind(False).alias("bad"))


def train_sharded(dealt: DataFrame) -> list[Network]:
    """The networks of :func:`deal_shards`' stored shards: each shard trains from the same weights, and weights are averaged."""
    spark = dealt.sparkSession
    rounds = ROUNDS if dealt.agg(F.max("shard")).first()[0] else 1
    trainings = [Training(np.random.Generator(np.random.PCG64(7))) for _ in (0, 1)]
    for done in range(rounds):
        shared = by_value(spark, trainings)

        def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(batch.num_rows):
                    net, shard, good, bad = (c[at].as_py() for c in batch.columns)
                    training = shared()[net]
                    # Few labels are varied more often.
                    parts = [good, varied(good * min(VARIED, max(1, FEW // max(len(good), 1)))), bad]
                    contexts, labels = [c for p in parts for c in p], np.repeat([1.0, 1.0, 0.0], [len(p) for p in parts])
                    rng = np.random.Generator(np.random.PCG64([7, shard, done]))
                    training.run(contexts, labels, -(-epochs_of(len(contexts)) // rounds), 64, rng)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([net], pa.int32()), pa.array([len(contexts)], pa.int64()), pa.array([training.values().tolist()])], ["net", "n", "values"])

        learnt = task_each(dealt).mapInArrow(train, "net int, n bigint, values array<double>")
        # Sums of decimals are the same in any order.
        whole = lambda c: F.sum(c.cast("decimal(38,18)"))
        means = learnt.select("net", "n", F.posexplode("values").alias("at", "value")).groupBy("net", "at").agg(
            (whole(F.col("value") * F.col("n")).cast("double") / F.sum("n")).alias("mean")).collect()
        for net, training in enumerate(trainings):
            training.put(np.array([r["mean"] for r in sorted((r for r in means if r["net"] == net), key=lambda r: r["at"])]))
    return [t.net for t in trainings]


def count_outputs(held: DataFrame, networks: list[Network]) -> DataFrame:
    """Rows (net, base, z, n): how many contexts of ``held`` (net, base, context), and of the varied positive ones, have the output ``z`` / GRAIN."""
    shared = by_value(held.sparkSession, networks)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        networks = shared()
        for batch in batches:
            rows = list(zip(*(c.to_pylist() for c in batch.columns)))
            for net, network in enumerate(networks):
                for base in (True, False):
                    own = [c for k, b, c in rows if k == net and b == base]
                    z = np.clip(network.outputs(own + varied(own) if base else own), -HIGHEST, HIGHEST)
                    steps, n = np.unique(np.rint(z * GRAIN).astype(np.int32), return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([net] * len(n), pa.int32()), pa.array([base] * len(n), pa.bool_()), pa.array(steps), pa.array(n.astype(np.int64))], ["net", "base", "z", "n"])

    return held.mapInArrow(count, "net int, base boolean, z int, n bigint").groupBy("net", "base", "z").agg(F.sum("n").alias("n"))


def fit_networks(scanned: DataFrame, recall: float = RECALL) -> list[Network] | None:
    """Two networks for the candidates of either side, each trained on those of the other, from :func:`scan_documents`' table."""
    rows = scanned.select(F.explode("candidates").alias("_c")).select(
        (1 - F.col("_c.side")).cast("int").alias("net"), "_c.base", F.explode("_c.contexts").alias("context"))
    labels = checkpoint(rows.distinct())
    counts = {(r["net"], r["base"]): r for r in labels.groupBy("net", "base").agg(
        F.count("*").alias("n"), *[F.count_if(_held(k)).alias(f"held_{k}") for k in range(SALTS)]).collect()}
    if len(counts) < 4 or min(r["n"] for r in counts.values()) < LEAST:
        return None
    # Of few labels a hash may hold out none: the first one that does not is taken.
    shares = [min(min(r[f"held_{k}"] / r["n"] * 2, 1 - r[f"held_{k}"] / r["n"]) for r in counts.values()) for k in range(SALTS)]
    salt = next((k for k in range(SALTS) if shares[k] >= 1 / HELD), int(np.argmax(shares)))
    if not shares[salt]:
        return None
    dealt = checkpoint(deal_shards(labels.filter(~_held(salt)), {key: r["n"] - r[f"held_{salt}"] for key, r in counts.items()}))
    networks = train_sharded(dealt)
    found = count_outputs(labels.filter(_held(salt)), networks).collect()
    for k, net in enumerate(networks):
        own = [r for r in found if r["net"] == k]
        calibrate_counts(net, np.array([r["z"] / GRAIN for r in own]), np.array([r["base"] for r in own]), np.array([r["n"] for r in own]), recall)
    return networks


def find_secrets(documents: DataFrame, recall: float = RECALL) -> DataFrame:
    """doc_id and ``spans`` (kind, start, end; by start, then kind): the rules' findings and the network's."""
    scanned = checkpoint(scan_documents(documents))
    networks = fit_networks(scanned, recall)
    if networks is None:
        found = scanned.select("doc_id", "spans")
    else:
        shared = by_value(documents.sparkSession, networks)

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            networks = shared()
            for batch in batches:
                rows, lists = [], batch.column(2).to_pylist()
                flat = [(t, c) for t, own in enumerate(lists) for c in own if not c["base"]]
                added: dict[int, list] = {}
                for side, net in enumerate(networks):
                    own = [(t, c) for t, c in flat if c["side"] == side]
                    scores = net.scores([w for _, c in own for w in c["contexts"]])
                    begin = np.cumsum([0] + [len(c["contexts"]) for _, c in own])[:-1]
                    for (t, c), p in zip(own, np.maximum.reduceat(scores, begin).tolist() if own else []):
                        if p >= net.threshold:
                            added.setdefault(t, []).append({"kind": 3, "start": c["start"], "end": c["end"]})
                for t, own in enumerate(batch.column(1).to_pylist()):
                    rows.append(sorted(own + added.get(t, []), key=lambda s: (s["start"], s["kind"], s["end"])))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(_SPAN))], ["doc_id", "spans"])

        found = scanned.mapInArrow(score, "doc_id bigint, spans array<struct<kind:tinyint,start:int,end:int>>")
    named = F.transform("spans", lambda s: F.struct(
        F.element_at(F.array(*map(F.lit, KINDS)), (s["kind"] + 1).cast("int")).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return found.select("doc_id", named.alias("spans"))


def secret_digest(found: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans (text) of :func:`find_secrets`."""
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["kind"] != KINDS[3])
    return found.select("doc_id", *[count(k) for k in KINDS[:3]], F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))
