"""Substring deduplication by a distributed merge sort of suffixes that never compares a known common prefix again.

Texts are stored in chunks, files in the shared folder, with the blocks that the windows below form. A round sorts keys of all chunks:

* each chunk sorts its own keys and drops repeats: a *run*. Runs are front-coded (the length of the prefix
  shared with the key before, and the rest), cut at splitting keys, and exchanged by key range;
* each range merges its runs with a loser tree. Every key in the tree carries the length of its common prefix with
  the key that was put out last: of two keys the one with the longer prefix is the smaller one, and only keys
  with equal prefixes are compared, from the end of that prefix on;
* what the merge finds goes back to the chunks as one code for each key of the run, in its order.

Sorting every suffix would exchange many times the input. Windows of ``WINDOW`` bytes are instead known by an anchor: the window's
place with the least hash of SHARED bytes. Equal windows have equal anchors at equal distances, and neighbouring windows with the
same anchor form a block. Three rounds find all windows that start in a smaller document too:

1. the suffixes at the anchors to a depth of SHARED bytes: windows of blocks whose prefix occurs in one document only are unique;
2. the others by all that belongs to the block, from the anchor onwards and then backwards: blocks of equal content are settled as a whole,
   and where a prefix has differing contents of several documents, their windows are compared as they come out of the merge;
3. prefixes with more than GROUP contents, and those that may go on beyond the border of a range, are not held together: their windows
   are sorted and merged as keys of their own.

Keys are compared as bytes, hashes only choose the anchors. A chunk sends equal keys once, so a hot passage is
sent once for each chunk, and the splitting keys of round 2 may divide one hot prefix. The splitting keys come from a sample
of the chunks, which decides on the balance only.

Nulls: a null text is empty. A null doc_id is larger than any other, and rows without an id, like rows with equal ids, do
not find each other. Repeated rows are documents of their own. Other columns are ignored.
"""

from __future__ import annotations

import functools
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.files import folder_uri, fresh_name, make_folder, open_input, open_output
from tidemark.llm.words import mix
from tidemark.sources.durable import checkpoint, scratch_path

WINDOW = 50
SHARED = 24
REACH = WINDOW - SHARED
CHUNK_BYTES = 8 << 20
RANGE_BYTES = 16 << 20
STEP = 1 << 16
GROUP = 4096
SAMPLED_CHUNKS = 8
SAMPLED_KEYS = 512
CHUNKS_A_TASK = 2

BLOCKS = b"blocks"  # what a chunk's file says beside its texts
PAD = 255  # in no UTF-8 text
# Codes of keys: the bits below say which windows of a block start in a smaller document.
SMALLER, ASKED = 1 << 31, 1 << 30
NO_ID = 1 << 63
_U, _A = np.uint64, np.uint32


# Chunks


def _store_chunks(documents: DataFrame, folder: str) -> DataFrame:
    """Rows (path, n_bytes) of the files written."""
    schema = pa.schema([("doc", pa.int64()), ("text", pa.large_string())])

    def write(tables: list[pa.RecordBatch]) -> pa.RecordBatch:
        path = fresh_name(folder, "arrow")
        n = 0
        blocks = _pack_blocks(*_cut(*_joined(pa.Table.from_batches(tables, schema))))
        with open_output(path) as out, pa.ipc.new_file(out, schema.with_metadata({BLOCKS: blocks}), options=pa.ipc.IpcWriteOptions(compression="zstd")) as file:
            for table in tables:
                file.write_batch(table.replace_schema_metadata({BLOCKS: blocks}))
                n += table.column(1).nbytes
        return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([n], pa.int64())], ["path", "n_bytes"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            texts = batch.column(1).cast(pa.large_string()).fill_null("")
            offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
            at = 0
            while at < len(texts):
                end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK_BYTES - size, "right")) - 1)
                held.append(pa.RecordBatch.from_arrays([batch.column(0).slice(at, end - at), texts.slice(at, end - at)], schema=schema))
                size += int(offsets[end] - offsets[at])
                if end < len(texts) or size >= CHUNK_BYTES:
                    yield write(held)
                    held, size = [], 0
                at = end
        if held:
            yield write(held)

    docs = documents.select(F.col("doc_id").cast("bigint").alias("doc"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(scan, "path string, n_bytes bigint")


_held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []


def _powers() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values of bytes, and powers of a random base and of its inverse, for at least a step; made once in each worker."""
    if not _held or len(_held[0][1]) < STEP + WINDOW:
        rng = np.random.Generator(np.random.PCG64(7))
        table, base = rng.integers(0, 2**64, 256, dtype=_U), int(rng.integers(0, 2**64, dtype=_U)) | 1
        grown = []
        for factor in (base, pow(base, -1, 2**64)):
            powers = np.full(STEP + WINDOW, factor, _U)
            powers[0] = 1
            grown.append(np.cumprod(powers))
        _held[:] = [(table, *grown)]
    return _held[0]


def _anchors(data: np.ndarray) -> np.ndarray:
    """For each window of ``data`` the place of its anchor."""
    table, up, down = _powers()
    n = len(data) - WINDOW + 1
    found = np.empty(n, np.int64)
    for at in range(0, n, STEP):
        piece = data[at:at + STEP + WINDOW - 1]
        sums = np.zeros(len(piece) + 1, _U)
        np.cumsum(table[piece] * up[:len(piece)], out=sums[1:])
        grams = mix((sums[SHARED:] - sums[:-SHARED]) * down[:len(piece) - SHARED + 1])
        # The hash above, the place below: the least is the leftmost of the least hashes.
        least = (grams >> _U(20) << _U(20)) + np.arange(len(grams), dtype=_U)
        width = 1
        while width < REACH + 1:
            step = min(width, REACH + 1 - width)
            least = np.minimum(least[:-step], least[step:])
            width += step
        found[at:at + len(least)] = (least & _U((1 << 20) - 1)).astype(np.int64) + at
    return found


def _joined(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and where each begins, and the end."""
    texts = table.column(1).combine_chunks()
    texts = texts.chunk(0) if isinstance(texts, pa.ChunkedArray) else texts
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def _cut(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All blocks: first window, number of windows, anchor."""
    none = np.zeros(0, np.int64)
    if len(data) < WINDOW:
        return none, none, none
    anchor = _anchors(data)
    valid = np.ones(len(anchor) + 1, bool)
    valid[-1] = False
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        valid[max(a, b - WINDOW + 1):b] = False
    same = np.append(anchor[1:] == anchor[:-1], False) & valid[1:] & valid[:-1]
    begin = np.flatnonzero(valid[:-1] & ~np.append(False, same[:-1]))
    return begin, np.flatnonzero(valid[:-1] & ~same) - begin + 1, anchor[begin]


def _pack_blocks(begin: np.ndarray, count: np.ndarray, anchor: np.ndarray) -> bytes:
    packed = np.diff(begin, prepend=0).astype(np.int32).tobytes() + count.astype(np.uint8).tobytes() + (anchor - begin).astype(np.uint8).tobytes()
    return zstandard.ZstdCompressor(level=1).compress(packed)


def _unpack_blocks(packed: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(packed)
    n = len(raw) // 6
    begin = np.cumsum(np.frombuffer(raw, np.int32, n).astype(np.int64))
    return begin, np.frombuffer(raw, np.uint8, n, 4 * n).astype(np.int64), begin + np.frombuffer(raw, np.uint8, n, 5 * n)


def _rows(data: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """The ``width`` bytes from each place on."""
    if not len(at):
        return np.zeros((0, width), np.uint8)
    data = np.ascontiguousarray(data)
    return np.ndarray((len(data) - width + 1,), f"V{width}", data, strides=(1,))[at].view(np.uint8).reshape(-1, width)


def _order(keys: np.ndarray, tie: np.ndarray) -> np.ndarray:
    """The order of byte rows, equal ones by ``tie``; each column of eight bytes is sorted only where those before it are equal."""
    n, width = keys.shape

    def word(rows: np.ndarray, c: int) -> np.ndarray:
        part = np.zeros((len(rows), 8), np.uint8)
        part[:, :min(8, width - c)] = keys[rows, c:c + 8]
        return part.view(">u8").ravel().astype(_U)

    first = word(np.arange(n), 0)
    order = np.argsort(first)
    value, group, slots = first[order], np.zeros(n, np.int64), np.arange(n)
    for c in [*range(8, width, 8), None]:
        new = np.append(True, (value[1:] != value[:-1]) | (group[1:] != group[:-1]))[:len(slots)]
        group = np.maximum.accumulate(np.where(new, slots, 0))
        tied = ~new | ~np.append(new[1:], True)[:len(slots)]
        slots, group = slots[tied], group[tied]
        if not len(slots):
            break
        rows = order[slots]
        value = tie[rows] if c is None else word(rows, c)
        again = np.lexsort((value, group))
        order[slots], value = rows[again], value[again]
    return order


class Keys:
    """The run of a chunk: distinct keys in order, the place of each input row among them, and the least owner of each."""

    def __init__(self, rows: np.ndarray, who: np.ndarray):
        order = _order(rows, who)
        rows, who = np.ascontiguousarray(rows[order]), who[order]
        listed = rows.view(f"S{rows.shape[1]}").ravel()
        new = np.append(True, listed[1:] != listed[:-1])[:len(rows)]
        self.keys, self.least = rows[new], who[new]
        self.of = np.empty(len(order), np.int64)
        self.of[order] = np.cumsum(new) - 1
        last = np.append(np.flatnonzero(new)[1:], len(rows)).astype(np.int64) - 1
        self.several = who[last] > self.least if len(rows) else np.zeros(0, bool)


class Chunk:
    """The texts of one file and what the rounds need of them, read when first used.

    ``tied``: the blocks that :meth:`pack_tied` found after round 1. ``answers``: the codes of the rounds, for the keys of their runs.
    """

    def __init__(self, path: str, tied: bytes | None, answers: list[np.ndarray]):
        self.path, self.answers, self._tied = path, answers, tied

    @functools.cached_property
    def table(self) -> pa.Table:
        with open_input(self.path) as file:
            return pa.ipc.open_file(file).read_all()

    @functools.cached_property
    def _text(self) -> tuple[np.ndarray, np.ndarray]:
        return _joined(self.table)

    @property
    def data(self) -> np.ndarray:
        return self._text[0]

    @property
    def offsets(self) -> np.ndarray:
        return self._text[1]

    @functools.cached_property
    def _owners(self) -> tuple[np.ndarray, np.ndarray]:
        """The ids in order, and for each text the number of its own; rows without one come last and are equal to each other."""
        docs = self.table.column(0)
        null = docs.is_null().to_numpy()
        ids, who = np.unique(docs.fill_null(0).to_numpy()[~null], return_inverse=True)
        numbers = np.full(len(null), len(ids), np.int64)
        numbers[~null] = who
        return ids, numbers

    def owner(self, who: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """doc_id, and whether there is none."""
        ids, _ = self._owners
        return np.append(ids, 0)[who], who == len(ids)

    def who(self, begin: np.ndarray) -> np.ndarray:
        """The owner's number at each place."""
        return self._owners[1][np.searchsorted(self.offsets, begin, "right") - 1]

    @functools.cached_property
    def cut(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All blocks, as they were stored with the texts."""
        return _unpack_blocks(self.table.schema.metadata[BLOCKS])

    def prefixes(self) -> Keys:
        """Round 1: the suffixes at the anchors."""
        begin, _, anchor = self.cut
        return Keys(_rows(self.data, anchor, SHARED), self.who(begin))

    def pack_tied(self) -> bytes:
        """The blocks whose prefix several documents have."""
        run = self.prefixes()
        tied = np.flatnonzero((run.several | (self.answers[0] == ASKED))[run.of])
        return _pack_blocks(*(x[tied] for x in self.cut))

    @functools.cached_property
    def tied(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return _unpack_blocks(self._tied)

    def contents(self) -> Keys:
        """Round 2: all bytes of the blocks' windows, from the anchor onwards and from there backwards."""
        begin, count, anchor = self.tied
        onwards = _rows(np.append(self.data, np.full(WINDOW, PAD, np.uint8)), anchor, WINDOW)
        onwards[np.arange(WINDOW) >= (begin + count - 1 + WINDOW - anchor)[:, None]] = PAD
        backwards = _rows(np.append(self.data[::-1], np.full(REACH, PAD, np.uint8)), len(self.data) - anchor, REACH)
        backwards[np.arange(REACH) >= (anchor - begin)[:, None]] = PAD
        return Keys(np.hstack([onwards, backwards]), self.who(begin))

    def asked(self, run: Keys) -> np.ndarray:
        """The windows (places) that are to be compared one by one, of the tied blocks with contents ``run``."""
        begin, count, _ = self.tied
        blocks = np.flatnonzero((self.answers[1] & _A(ASKED) > 0)[run.of] & (self.who(begin) == run.least[run.of]))
        begin, count = begin[blocks], count[blocks]
        return np.repeat(begin - (np.cumsum(count) - count), count) + np.arange(count.sum())

    def windows(self, places: np.ndarray) -> Keys:
        """Round 3."""
        return Keys(_rows(self.data, places, WINDOW), self.who(places))

    def run(self) -> Keys:
        """The run of the round after those answered."""
        if not self.answers:
            return self.prefixes()
        if len(self.answers) == 1:
            return self.contents()
        if not (self.answers[1] & _A(ASKED)).any():
            return Keys(np.zeros((0, WINDOW), np.uint8), np.zeros(0, np.int64))
        return self.windows(self.asked(self.contents()))

    def removed(self) -> np.ndarray:
        """For each byte whether it is covered by a window that starts in a smaller document, after all rounds."""
        begin, count, _ = self.tied
        run = self.contents()
        codes, ahead = self.answers[1][run.of], self.who(begin) > run.least[run.of]
        whole = ahead | (codes & _A(SMALLER) > 0)
        single = [begin[~whole & (codes >> _A(k) & _A(1) > 0)] + k for k in range(REACH + 1)]
        asked = self.asked(run)
        windows = self.windows(asked)
        single.append(asked[(self.who(asked) > windows.least[windows.of]) | (self.answers[2] & _A(SMALLER) > 0)[windows.of]])
        places = np.concatenate(single)
        edge = np.zeros(len(self.data) + 1, np.int32)
        np.add.at(edge, np.append(begin[whole], places), 1)
        np.add.at(edge, np.append(begin[whole] + count[whole], places + 1) + WINDOW - 1, -1)
        return np.cumsum(edge)[:-1] > 0


# Runs and their merge


def _pack(run: Keys, chunk: Chunk, a: int, b: int) -> bytes:
    """Keys a to b of a run, front-coded: counts, then common prefixes, owners, flags and the rest of each key."""
    keys = run.keys[a:b]
    common = np.zeros(b - a, np.uint8)
    common[1:] = (keys[1:] != keys[:-1]).argmax(axis=1)
    doc, null = chunk.owner(run.least[a:b])
    flags = null + 2 * run.several[a:b].astype(np.uint8)
    rest = keys[np.arange(keys.shape[1]) >= common[:, None]]
    # Bytes of equal weight stand together, which compresses better.
    ids = np.ascontiguousarray(doc.astype(np.int64).view(np.uint8).reshape(-1, 8).T)
    parts = [np.array([b - a, keys.shape[1]], np.int32).tobytes(), common.tobytes(), flags.astype(np.uint8).tobytes(), ids.tobytes(), rest.tobytes()]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


class Packed:
    """A part of a run, read back."""

    def __init__(self, blob: bytes):
        raw = zstandard.ZstdDecompressor().decompress(blob)
        self.n, self.width = (int(x) for x in np.frombuffer(raw, np.int32, 2))
        n = self.n
        self.common = np.frombuffer(raw, np.uint8, n, 8)
        flags = np.frombuffer(raw, np.uint8, n, 8 + n)
        self.several = (flags & 2 > 0).tolist() if (flags & 2).any() else None
        ids = np.frombuffer(raw, np.uint8, 8 * n, 8 + 2 * n).reshape(8, n).T
        self.owner = np.ascontiguousarray(ids).view(np.int64).ravel().tolist()
        for k in np.flatnonzero(flags & 1).tolist():
            self.owner[k] = NO_ID
        self.rest, self.codes = raw[8 + 10 * n:], array("I", bytes(4 * n))

    def entries(self) -> Iterator[tuple[int, bytes]]:
        """Common prefix and rest of each key."""
        at, rest = 0, self.rest
        for k in range(0, self.n, 1024):
            common = self.common[k:k + 1024]
            for shared, size in zip(common.tolist(), (self.width - common.astype(np.int64)).tolist()):
                yield shared, rest[at:at + size]
                at += size


def merged(runs: list[Packed]) -> Iterator[tuple[int, int, int, bytes]]:
    """All keys of the runs in order: (run, index in it, length of the prefix shared with the key before, key)."""
    k = len(runs)
    source = [r.entries() for r in runs]
    keys, common, index = [b""] * k, [-1] * k, [0] * k
    for i in range(k):
        first = next(source[i], None)
        if first is not None:
            keys[i], common[i] = first[1], 0

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser) of two heads whose common prefixes are with the same key."""
        x, y = common[a], common[b]
        if x != y:
            return (a, b) if x > y else (b, a)
        if x < 0:
            return a, b
        left, right = keys[a], keys[b]
        if left[x:] == right[x:]:
            common[b] = len(left)
            return a, b
        while left[x] == right[x]:
            x += 1
        if left[x] < right[x]:
            common[b] = x
            return a, b
        common[a] = x
        return b, a

    # tree[1:k] holds losers, leaf i stands at k + i.
    tree, winners = [0] * k, [0] * k + list(range(k))
    for node in range(k - 1, 0, -1):
        winners[node], tree[node] = play(winners[2 * node], winners[2 * node + 1])
    top = winners[1] if k > 1 else 0
    width = runs[0].width if runs else 0
    while k and common[top] >= 0:
        key = keys[top]
        yield top, index[top], common[top], key
        index[top] += 1
        following = next(source[top], None)
        if following is None:
            mine = common[top] = -1
        else:
            mine, rest = following
            common[top] = mine
            keys[top] = key = key[:mine] + rest
        # As in play(), written out: this loop is most of the work.
        node = (top + k) >> 1
        while node:
            other = tree[node]
            theirs = common[other]
            if theirs > mine:
                tree[node], top, mine, key = top, other, theirs, keys[other]
            elif theirs == mine and 0 <= mine < width:
                rival, x = keys[other], mine
                left, right = key[x], rival[x]
                if left == right:
                    if key[x:] == rival[x:]:
                        common[other] = width
                        node >>= 1
                        continue
                    x += 1
                    while key[x] == rival[x]:
                        x += 1
                    left, right = key[x], rival[x]
                if left < right:
                    common[other] = x
                else:
                    common[top] = x
                    tree[node], top, key = top, other, rival
            node >>= 1


def _judge_prefixes(runs: list[Packed], fixed: list[bytes]) -> None:
    """Codes ASKED for keys that several documents have."""
    width = runs[0].width
    for run in runs:
        for at, several in enumerate(run.several or ()):
            if several:
                run.codes[at] = ASKED

    def close(same: list[tuple[int, int, int, bytes]]) -> None:
        owner = runs[same[0][0]].owner[same[0][1]]
        if any([runs[i].owner[at] != owner or runs[i].codes[at] for i, at, _, _ in same]):
            for i, at, _, _ in same:
                runs[i].codes[at] = ASKED

    before, same = None, []
    for entry in merged(runs):
        if entry[2] == width:
            same.append(entry)
            continue
        if same:
            close([before, *same])
            same = []
        before = entry
    if same:
        close([before, *same])


def _judge_smaller(runs: list[Packed], same: list[tuple[int, int]]) -> tuple[int, list[tuple[int, int]]]:
    """Of runs with an equal key: the least owner, and those that have it; the others get the code SMALLER."""
    if len(same) == 1:
        return runs[same[0][0]].owner[same[0][1]], same
    least = min([runs[i].owner[at] for i, at in same])
    holders = []
    for i, at in same:
        if runs[i].owner[at] > least:
            runs[i].codes[at] = SMALLER
        else:
            holders.append((i, at))
    return least, holders


def _judge_contents(runs: list[Packed], fixed: list[bytes]) -> None:
    """SMALLER for contents that a smaller document has too; where a prefix has several contents of several documents, their copied windows.

    ``fixed``: the keys at the range's borders. Prefixes that may go on beyond them, and those with more than GROUP contents, are ASKED.
    """
    width = runs[0].width
    beyond = {key[:SHARED] for key in fixed if len(key) > SHARED}
    same: list[tuple[int, int]] = []
    group: list[tuple[bytes, int, list[tuple[int, int]]]] = []
    ask, last = False, b""

    def close_content() -> None:
        nonlocal group, ask
        least, holders = _judge_smaller(runs, same)
        group.append((last, least, holders))
        if ask or len(group) > GROUP:
            ask = True
            for _, _, holders in group:
                for i, at in holders:
                    runs[i].codes[at] = ASKED
            group = []

    def close_group() -> None:
        if len(group) > 1 and any([least != group[0][1] for _, least, _ in group]):
            _judge_group(runs, group)

    for i, at, shared, key in merged(runs):
        if shared < width:
            if same:
                close_content()
                same = []
            if shared < SHARED:
                close_group()
                group, ask = [], key[:SHARED] in beyond
            last = key
        same.append((i, at))
    if same:
        close_content()
    close_group()


def _judge_group(runs: list[Packed], group: list[tuple[bytes, int, list[tuple[int, int]]]]) -> None:
    """For each content the windows that another one has for a smaller document: one bit each, the first window lowest."""
    texts = [key[WINDOW:].rstrip(b"\xff")[::-1] + key[:WINDOW].rstrip(b"\xff") for key, _, _ in group]
    first: dict[bytes, int] = {}
    for text, (_, least, _) in zip(texts, group):
        for k in range(len(text) - WINDOW + 1):
            window = text[k:k + WINDOW]
            if first.get(window, NO_ID + 1) > least:
                first[window] = least
    for text, (_, least, holders) in zip(texts, group):
        code = sum(1 << k for k in range(len(text) - WINDOW + 1) if first[text[k:k + WINDOW]] < least)
        for i, at in holders:
            runs[i].codes[at] = code


def _judge_windows(runs: list[Packed], fixed: list[bytes]) -> None:
    """SMALLER for windows that a smaller document has too."""
    width = runs[0].width
    same: list[tuple[int, int]] = []
    for i, at, shared, _ in merged(runs):
        if shared < width:
            if len(same) > 1:
                _judge_smaller(runs, same)
            same = []
        same.append((i, at))
    if len(same) > 1:
        _judge_smaller(runs, same)


JUDGES = [_judge_prefixes, _judge_contents, _judge_windows]


def _answers(row_answers: list[list[dict] | None]) -> list[np.ndarray]:
    """The codes of each round, over all ranges in order."""
    read = zstandard.ZstdDecompressor()
    return [np.frombuffer(b"".join(read.decompress(a["codes"]) for a in sorted(answers or [], key=lambda a: a["range"])), np.uint32) for answers in row_answers]


def _each_chunk(rows: DataFrame, use: Callable[[Chunk], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``use`` on each chunk of (path, tied, codes) rows; codes: a list of answers for each round."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, tied, *codes in zip(*(batch.column(k) for k in range(batch.num_columns))):
                yield from use(Chunk(path.as_py(), tied.as_py(), _answers([c.as_py() for c in codes])))

    names = [c for c in rows.columns if c.startswith("codes_")]
    tied = F.col("tied") if "tied" in rows.columns else F.lit(None).cast("binary")
    return rows.select("path", tied.alias("tied"), *sorted(names)).mapInArrow(scan, schema)


def _splitters(chunks: DataFrame, n_chunks: int, ranges: int) -> list[bytes]:
    """At most ranges - 1 keys that divide the keys of a sample of the chunks evenly, cut to what tells each from the one before."""
    if ranges < 2:
        return []
    some = chunks if n_chunks <= SAMPLED_CHUNKS else chunks.filter(F.pmod(F.xxhash64("path"), F.lit(SAMPLED_CHUNKS)) == 0)

    def sample(chunk: Chunk) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array([k.tobytes() for k in chunk.run().keys[::SAMPLED_KEYS]], pa.binary())], ["key"])

    keys = checkpoint(_each_chunk(some, sample, "key binary"))
    parts = keys.repartitionByRange(ranges, "key").groupBy(F.spark_partition_id().alias("part")).agg(F.min("key").alias("key"), F.max("key").alias("last"))
    rows = sorted((bytes(r.key), bytes(r.last)) for r in parts.collect())
    cut = []
    for (_, before), (key, _) in zip(rows, rows[1:]):
        n = next((k for k in range(len(key)) if before[k] != key[k]), len(key) - 1) + 1
        cut.append(key[:n])
    return sorted(set(cut))


def _round(chunks: DataFrame, n_chunks: int, rounds: int, ranges: int) -> DataFrame:
    """``chunks`` with the codes of one more round."""
    borders = _splitters(chunks, n_chunks, ranges)
    judge = JUDGES[rounds]

    def send(chunk: Chunk) -> Iterator[pa.RecordBatch]:
        run = chunk.run()
        n, width = run.keys.shape
        listed = np.ascontiguousarray(run.keys).view(f"S{width}").ravel() if n else np.zeros(0, f"S{width}")
        cuts = np.concatenate([[0], np.searchsorted(listed, np.array(borders, f"S{width}")) if borders else [], [n]]).astype(np.int64).tolist()
        for part, (a, b) in enumerate(zip(cuts, cuts[1:])):
            if a < b:
                fixed = [borders[p] for p in (part - 1, part) if 0 <= p < len(borders)]
                yield pa.RecordBatch.from_arrays([
                    pa.array([part], pa.int32()), pa.array([chunk.path]), pa.array([fixed], pa.list_(pa.binary())), pa.array([_pack(run, chunk, a, b)], pa.binary()),
                ], ["range", "path", "fixed", "blob"])

    def merge(table: pa.Table) -> pa.Table:
        runs = [Packed(blob.as_py()) for blob in table.column("blob")]
        judge(runs, table.column("fixed")[0].as_py())
        pack = zstandard.ZstdCompressor(level=1)
        return pa.table([table.column("path"), table.column("range"), pa.array([pack.compress(r.codes.tobytes()) for r in runs], pa.binary())], ["path", "range", "codes"])

    sent = _each_chunk(chunks, send, "range int, path string, fixed array<binary>, blob binary")
    codes = checkpoint(sent.groupBy("range").applyInArrow(merge, "path string, range int, codes binary"))
    # A chunk has one piece for each range: as many bytes as keys.
    per_chunk = codes.groupBy("path").agg(F.collect_list(F.struct("range", "codes")).alias(f"codes_{rounds}"))
    return _dealt(checkpoint(chunks.join(per_chunk, "path", "left")), n_chunks)


def _dealt(chunks: DataFrame, n_chunks: int) -> DataFrame:
    """A few files a task. Without a number adaptive execution would see few short rows and use one task."""
    return chunks.repartition(max(1, n_chunks // CHUNKS_A_TASK))


FOUND = "doc_id bigint, n_bytes bigint, spans array<struct<start:bigint,end:bigint>>, kept binary"


def suffix_dedup(documents: DataFrame) -> DataFrame:
    """doc_id, n_bytes, ``spans`` (removed byte ranges: those covered by a window of WINDOW bytes that starts in a smaller document too) and ``kept``, the other bytes."""
    folder = scratch_path(documents.sparkSession, "suffix-chunks")
    make_folder(folder_uri(folder))
    stored = checkpoint(_store_chunks(documents, folder_uri(folder)))
    total = stored.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("n_bytes"), F.lit(0)).alias("n_bytes")).first()
    chunks, ranges = _dealt(stored.select("path"), total["n"]), 1 + total["n_bytes"] // RANGE_BYTES

    def tied(chunk: Chunk) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array([chunk.path]), pa.array([chunk.pack_tied()], pa.binary())], ["path", "tied"])

    chunks = _round(chunks, total["n"], 0, ranges)
    blocks = checkpoint(_each_chunk(chunks, tied, "path string, tied binary"))
    chunks = _dealt(checkpoint(chunks.join(blocks, "path")), total["n"])
    for rounds in (1, 2):
        chunks = _round(chunks, total["n"], rounds, ranges)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def apply(chunk: Chunk) -> Iterator[pa.RecordBatch]:
        gone = chunk.removed()
        spans, kept = [], []
        for a, b in zip(chunk.offsets[:-1].tolist(), chunk.offsets[1:].tolist()):
            cut = gone[a:b]
            turns = np.flatnonzero(np.diff(np.concatenate([[0], cut.astype(np.int8), [0]])))
            spans.append([{"start": s, "end": e} for s, e in turns.reshape(-1, 2).tolist()])
            kept.append((chunk.data[a:b][~cut] if len(turns) else chunk.data[a:b]).tobytes())
        yield pa.RecordBatch.from_arrays([chunk.table.column(0).combine_chunks(), pa.array(np.diff(chunk.offsets)), pa.array(spans, kind), pa.array(kept, pa.binary())],
                                         ["doc_id", "n_bytes", "spans", "kept"])

    return _each_chunk(chunks, apply, FOUND)
