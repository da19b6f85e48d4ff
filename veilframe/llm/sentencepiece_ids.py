"""SentencePiece encoding and decoding by a streaming Viterbi search over a model file's pieces.

A text is read left to right. Each position keeps one backpointer, the piece that the best path to it ends
with. Only as many positions stay open as the longest piece has letters; as soon as the paths of all of
them pass through one boundary, the ids up to it are final and are given out.

Which path is best depends on the model. For a unigram model it is that of the largest sum of scores. A
byte-pair model merges instead, the best pair first; of all segmentations of a text into pieces its result
is the only one in which every two neighbours would also be left side by side if merged by themselves. So
there a piece continues only a path whose last piece it may stand beside, and one path lives at each position.

In a batch the search runs over many stretches at once, one letter of each at a step, in arrays. A stretch is
what lies between two spaces: where no piece runs on over a space, all paths meet before each, so the ids of
a stretch are final by themselves and are looked up when it comes again.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MARK = "▁"
#: Stretches kept with their ids in each Python worker, twice so many with those of the last change; letters searched and ids passed on at a time.
CACHE, LETTERS, FLUSH = 100_000, 1 << 22, 1 << 19
#: Letters of a stretch that are matched with pieces at a time.
STEPS = 1 << 14
#: Longest stretch that is kept, and pairs of pieces kept with whether they may be neighbours.
KEPT, PAIRS = 64, 1 << 20
UNIT = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
UNIGRAM, BPE = 1, 2  # fixed values: model types of a model file
_FREE = np.int64(-1)


class Table:
    """Whole numbers from 0 by key, looked up for many keys at a time; -1 for a key that is not there."""

    def __init__(self, keys: np.ndarray | None = None, values: np.ndarray | None = None) -> None:
        self.n, self.bits = 0, 10
        self.keys, self.values = np.full(1 << self.bits, _FREE), np.zeros(1 << self.bits, np.int32)
        if keys is not None:
            self.add(keys, values)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Different keys, none of which is there yet."""
        if 2 * (self.n + keys.size) > 1 << self.bits:
            old = self.keys != _FREE
            keys, values = np.concatenate([self.keys[old], keys]), np.concatenate([self.values[old], values])
            self.n, self.bits = 0, int(3 * keys.size).bit_length()
            self.keys, self.values = np.full(1 << self.bits, _FREE), np.zeros(1 << self.bits, np.int32)
        at, last = self._slot(keys), (1 << self.bits) - 1
        todo = np.arange(keys.size)
        self.n += keys.size
        while todo.size:
            free = todo[self.keys[at[todo]] == _FREE]
            self.keys[at[free]] = keys[free]
            won = free[self.keys[at[free]] == keys[free]]
            self.values[at[won]] = values[won]
            todo = todo[self.keys[at[todo]] != keys[todo]]
            at[todo] = at[todo] + 1 & last

    def get(self, keys: np.ndarray) -> np.ndarray:
        at, last = self._slot(keys), (1 << self.bits) - 1
        there = self.keys[at]
        out = np.where(there == keys, self.values[at], -1)
        todo = np.flatnonzero((there != keys) & (there != _FREE))
        while todo.size:
            at[todo] = at[todo] + 1 & last
            there, want = self.keys[at[todo]], keys[todo]
            hit = there == want
            out[todo[hit]] = self.values[at[todo[hit]]]
            todo = todo[~hit & (there != _FREE)]
        return out


@dataclass
class Pieces:
    """A model's pieces. A character that is no piece costs ``fallback`` and becomes its UTF-8 bytes, or ``unk``."""

    ids: dict[str, int]
    scores: dict[str, float]
    bytes_: tuple[int, ...]
    unk: int
    spelled: list[bytes]
    kind: int = UNIGRAM
    longest: int = 1
    fallback: float = 0.0
    units: bool = True
    commits: int = 0
    _memo: dict = field(default_factory=dict, repr=False)
    _old: dict = field(default_factory=dict, repr=False)
    _code: np.ndarray | None = field(default=None, repr=False)
    _pairs: Table = field(default_factory=Table, repr=False)

    def __post_init__(self) -> None:
        self.longest = max(map(len, self.ids), default=1)
        self.fallback = min((s for s in self.scores.values() if s > -1e8), default=0.0) - 10
        self.units = not any(MARK in p.lstrip(MARK) for p in self.ids)  # then no piece runs on into the next word
        self.letters = sorted({c for p in self.ids for c in p})
        names = [*self.ids, *(c for c in self.letters if c not in self.ids)]  # letters that are no pieces can still be merged
        self.number = {p: i for i, p in enumerate(names)}
        self.id_of = np.array([self.ids.get(p, -1) for p in names], np.int64)
        self.score_of = np.array([self.scores.get(p, self.fallback) for p in names])
        if self.kind == BPE:
            self._merge_table(names)
        self._tree(names)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_memo": {}, "_old": {}, "_code": None, "_pairs": Table()}

    def _merge_table(self, names: list[str]) -> None:
        """Of each piece the two parts it is merged from last, and when; of pairs of pieces, when they are merged."""
        when = {s: i for i, s in enumerate(sorted(set(self.scores.values()), reverse=True))}
        rank = {p: when[s] for p, s in self.scores.items() if len(p) > 1}
        pairs = [(self.number[p[:i]], self.number[p[i:]], r) for p, r in rank.items() for i in range(1, len(p)) if p[:i] in self.number and p[i:] in self.number]
        a, b, r = (np.array(x, np.int64) for x in (zip(*pairs) if pairs else ((), (), ())))
        self.merges = Table(a * len(names) + b, r)
        self.rank, self.left, self.right = (np.full(len(names), -1, np.int64) for _ in range(3))
        for p in rank:
            own, last = list(p), None
            while len(own) > 1:
                found = [(rank[m], i) for i in range(len(own) - 1) if (m := own[i] + own[i + 1]) in rank]
                if not found:
                    break
                i = min(found)[1]
                last = own[i], own[i + 1]
                own[i : i + 2] = ["".join(last)]
            no = self.number[p]
            if len(own) == 1:
                self.rank[no], self.left[no], self.right[no] = rank[p], self.number[last[0]], self.number[last[1]]

    def _tree(self, names: list[str]) -> None:
        """The pieces as a tree read from their first letter. A piece that merging cannot reach is left out."""
        code = {c: i + 1 for i, c in enumerate(self.letters)}
        edges: dict[tuple[int, int], int] = {}
        ends = [-1]
        for no, p in enumerate(names):
            if len(p) > 1 and self.kind == BPE and self.rank[no] < 0:
                continue
            node = 0
            for c in p:
                key = node, code[c]
                if key not in edges:
                    edges[key] = len(ends)
                    ends.append(-1)
                node = edges[key]
            ends[node] = no
        self.span = len(self.letters) + 1
        self.edges = Table(np.array([n * self.span + c for n, c in edges], np.int64), np.array(list(edges.values()), np.int64))
        self.ends = np.array(ends, np.int64)

    def code(self, text: str) -> np.ndarray:
        """The number of each letter, 0 for one in no piece."""
        if self._code is None:
            self._code = np.zeros(0x110000, np.int32)
            self._code[[ord(c) for c in self.letters]] = np.arange(1, len(self.letters) + 1)
        return self._code[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]

    def beside(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging leaves ``a`` and ``b`` side by side; with nothing (-1) before it, it does.

        Merges are taken back, the last first, and of equal ones the right one first. Letters that meet at
        the border must not have a merge that would have come before the one taken back.
        """
        out = a < 0
        keys = a * len(self.id_of) + b
        known = self._pairs.get(keys)
        if (new := ~out & (known < 0)).any():
            fresh = np.unique(keys[new])
            x, y = fresh // len(self.id_of), fresh % len(self.id_of)
            good, todo = np.ones(fresh.size, bool), np.arange(fresh.size)
            limit = np.full(fresh.size, np.iinfo(np.int64).max)
            while todo.size:
                m = self.merges.get(x * len(self.id_of) + y)
                bad = (m >= 0) & (2 * m.astype(np.int64) < limit)
                good[todo[bad]] = False
                rx, ry = self.rank[x], self.rank[y]
                on = ~bad & ((rx >= 0) | (ry >= 0))
                first = rx > ry
                limit = np.where(first, 2 * rx, 2 * ry + 1)[on]
                x, y, todo = np.where(first, self.right[x], x)[on], np.where(first, y, self.left[y])[on], todo[on]
            if self._pairs.n + fresh.size > PAIRS:
                self._pairs = Table()
                self._pairs.add(fresh, good)
                return self.beside(a, b)
            self._pairs.add(fresh, good)
            known = self._pairs.get(keys)
        return out | (known == 1)

    def outside(self, char: str) -> tuple[int, ...]:
        return tuple(self.bytes_[b] for b in char.encode("utf-8", "surrogatepass")) if self.bytes_ else (self.unk,)


def _varint(data: bytes, i: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        n |= (data[i] & 127) << shift
        shift, i = shift + 7, i + 1
        if not data[i - 1] & 128:
            return n, i


def _field(data: bytes, no: int) -> bytes | int | None:
    """The last value of a field of a protocol-buffer message."""
    i, found = 0, None
    while i < len(data):
        tag, i = _varint(data, i)
        if tag & 7 == 0:
            value, i = _varint(data, i)
        else:
            n, i = _varint(data, i) if tag & 7 == 2 else (4 if tag & 7 == 5 else 8, i)
            value, i = data[i : i + n], i + n
        found = value if tag >> 3 == no else found
    return found


def load(path: str) -> Pieces:
    """The pieces of a model file, read on the driver; they are small enough to send to every task.

    Unigram and byte-pair models without pieces of the user's own and without a text normalisation.
    """
    import sentencepiece

    with open(path, "rb") as f:
        proto = f.read()
    trainer = _field(proto, 2) or b""
    kind = _field(trainer, 3) or UNIGRAM
    if kind not in (UNIGRAM, BPE):
        raise ValueError(f"a model of type {kind} is neither unigram nor byte-pair")
    sp = sentencepiece.SentencePieceProcessor(model_proto=proto)
    ids, scores, byte_ids, spelled = {}, {}, {}, []
    for i in range(sp.get_piece_size()):
        piece = sp.id_to_piece(i)
        if sp.is_byte(i):
            byte_ids[int(piece[3:5], 16)] = i
            spelled.append(bytes([int(piece[3:5], 16)]))
        elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
            spelled.append(" ⁇ ".encode() if sp.is_unknown(i) else b"")
        else:
            ids[piece], scores[piece] = i, sp.get_score(i)
            spelled.append(piece.replace(MARK, " ").encode())
    return Pieces(ids, scores, tuple(byte_ids[b] for b in range(256)) if len(byte_ids) == 256 else (), sp.unk_id(), spelled, kind)


class _Lanes:
    """The search over many stretches at once, the longest first; ``window`` positions of each are held."""

    def __init__(self, pieces: Pieces, stretches: list[str]) -> None:
        self.p, self.stretches, self.sizes = pieces, stretches, np.array([len(s) for s in stretches], np.int64)
        self.base = np.zeros(self.sizes.size, np.int64)  # the last final boundary of each
        self.window = int(min(self.sizes.max(initial=0), 4 * pieces.longest)) + 1
        shape = (self.sizes.size, self.window)
        self.took, self.piece = np.zeros(shape, np.int16), np.full(shape, -1, np.int32)  # letters and number of the last piece
        self.best = np.zeros(shape) if pieces.kind == UNIGRAM else None
        self.out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def _match(self, lo: int, n: int) -> None:
        """Of letters ``lo`` to ``lo + STEPS`` of the first ``n`` stretches, one after the other from ``starts``:
        ``found[k, i]``: the piece of k + 1 letters that ends with letter i; ``which``: for which k there is one."""
        before = min(lo, self.p.longest - 1)
        code = self.p.code("".join([s[lo - before : lo + STEPS] for s in self.stretches[:n]]))
        own = np.minimum(self.sizes[:n] - lo, STEPS)
        read = np.cumsum(own + before) - own - before
        self.starts = np.cumsum(own) - own
        self.found = np.empty((self.p.longest, own.sum()), np.int32)  # looked at only where ``which`` tells so
        self.which = np.zeros(own.sum(), np.int64)
        to = np.repeat(self.starts - read - before, own + before)  # from a letter's place in ``code`` to its place here
        ends = np.repeat(read + own + before, own + before)
        at, node = np.arange(code.size), np.zeros(code.size, np.int64)
        for k in range(self.p.longest):
            on = at + k < ends[at]
            at, node = at[on], node[on]
            node = self.p.edges.get(node * self.p.span + code[at + k]).astype(np.int64)
            at, node = at[node >= 0], node[node >= 0]
            no = self.p.ends[node]
            hit = (no >= 0) & (at + k - ends[at] + own.repeat(own + before)[at] >= 0) if before else no >= 0
            end = at[hit] + k + to[at[hit]]
            self.found[k, end] = no[hit]
            self.which[end] |= 1 << k

    def _merged(self, lanes: np.ndarray, at: np.ndarray, now: np.ndarray) -> None:
        """The one piece that may end here: of those whose last neighbour it may stand beside."""
        which = self.which[at]
        while True:
            on = which > 0
            lanes, at, now, which = lanes[on], at[on], now[on], which[on]
            if not lanes.size:
                return
            d = np.frexp(which.astype(float))[1].astype(np.int64) - 1
            no = self.found[d, at].astype(np.int64)
            good = self.p.beside(self.piece[lanes, now - d - 1].astype(np.int64), no)
            self.took[lanes[good], now[good]], self.piece[lanes[good], now[good]] = d[good] + 1, no[good]
            which = np.where(good, 0, which ^ 1 << d)

    def _summed(self, lanes: np.ndarray, at: np.ndarray, now: np.ndarray) -> None:
        """The piece that ends the path of the largest sum; of equal ones the longer."""
        top = np.where(self.which[at] & 1, -np.inf, self.best[lanes, now - 1] + self.p.fallback)
        for d in range(self.p.longest):
            on = np.flatnonzero(self.which[at] >> d & 1)
            no = self.found[d, at[on]]
            s = self.best[lanes[on], now[on] - d - 1] + self.p.score_of[no]
            good = s >= top[on]
            on, no = on[good], no[good]
            top[on] = s[good]
            self.took[lanes[on], now[on]], self.piece[lanes[on], now[on]] = d + 1, no
        self.best[lanes, now] = top

    def _give(self, lanes: np.ndarray, to: np.ndarray) -> None:
        """Hand out the path from ``to`` back to the last final boundary."""
        base = self.base[lanes]
        while lanes.size:
            took, no = self.took[lanes, to].astype(np.int64), self.piece[lanes, to]
            to = to - took
            self.out.append((lanes, base + to, no))
            on = to > 0
            lanes, to, base = lanes[on], to[on], base[on]

    def _commit(self, lanes: np.ndarray, now: np.ndarray) -> None:
        """Where the paths of all open positions meet, what lies before is final."""
        open_ = now[:, None] - np.arange(self.p.longest)
        while (split := open_.max(1) > open_.min(1)).any():
            some = open_[split]
            last = some.max(1)
            back = last - self.took[lanes[split], last]
            open_[split] = np.where(some == last[:, None], back[:, None], some)
        met = open_[:, 0]
        lanes, met = lanes[met > 0], met[met > 0]
        self._give(lanes, met)
        self.p.commits += lanes.size
        at = np.minimum(np.arange(self.window) + met[:, None], self.window - 1)
        for kept in (self.took, self.piece, self.best):
            if kept is not None:
                kept[lanes] = np.take_along_axis(kept[lanes], at, 1)
        if self.best is not None:
            self.best[lanes] -= self.best[lanes, :1]
        self.base[lanes] += met

    def run(self) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of all pieces, -1 for a letter outside, stretch after stretch, and where each stretch ends."""
        step = self._merged if self.p.kind == BPE else self._summed
        live = np.searchsorted(-self.sizes, -np.arange(1, self.sizes.max(initial=0) + 2), side="right")
        for end, n in enumerate(live[:-1], 1):
            lanes = np.arange(n)
            if (end - 1) % STEPS == 0:
                self._match(end - 1, n)
            now = end - self.base[:n]
            if now.max(initial=0) >= self.window:
                more = ((0, 0), (0, self.window))
                self.window *= 2
                self.took, self.piece = np.pad(self.took, more), np.pad(self.piece, more)
                self.best = None if self.best is None else np.pad(self.best, more)
            self.took[lanes, now], self.piece[lanes, now] = 1, -1
            step(lanes, self.starts[:n] + (end - 1) % STEPS, now)
            done = lanes[live[end] :]
            self._give(done, now[live[end] :])
            self.p.commits += done.size
            if end % self.p.longest == 0:
                on = lanes[: live[end]]
                on = on[now[on] >= 2 * self.p.longest]
                self._commit(on, now[on])
        lane, at, no = (np.concatenate([np.empty(0, np.int64), *x]) for x in (zip(*self.out) if self.out else ((), (), ())))
        return no[np.lexsort((at, lane))], np.cumsum(np.bincount(lane, minlength=self.sizes.size))


def search(stretches: Iterable[str], pieces: Pieces, out: dict[str, bytes]) -> None:
    """Into ``out`` the ids, as 32-bit integers, of texts with marks for spaces."""
    stretches = sorted(stretches, key=len, reverse=True)
    blocks = np.cumsum([len(s) for s in stretches]) // LETTERS
    for first, last in zip(s := np.flatnonzero(np.diff(blocks, prepend=-1)).tolist(), [*s[1:], len(stretches)]):
        own = stretches[first:last]
        no, ends = _Lanes(pieces, own).run()
        ids = np.where(no < 0, -1, pieces.id_of[no]).astype(np.int32)
        raw, cuts = ids.tobytes(), (4 * ends).tolist()
        out.update(zip(own, map(raw.__getitem__, map(slice, [0, *cuts], cuts))))
        for i in np.unique(np.searchsorted(ends, np.flatnonzero(ids < 0), side="right")).tolist():
            spread: list[int] = []
            at = 0
            for x in np.frombuffer(out[own[i]], np.int32).tolist():
                spread += (x,) if x >= 0 else pieces.outside(own[i][at])
                at += 1 if x < 0 else len(pieces.spelled[x].decode())
            out[own[i]] = np.array(spread, np.int32).tobytes()


def encode_texts(texts: list[str | None], pieces: Pieces) -> list[bytes | None]:
    """Ids, as 32-bit integers, of each text. A space is put before a text, as the model was made; an empty one has none."""
    split: list[list[str] | None] = []
    for text in texts:
        if not text:
            split.append(None if text is None else [])
        elif not pieces.units:
            split.append([MARK + text.replace(" ", MARK)])
        elif "  " in text or MARK in text or text[0] == " " or text[-1] == " ":
            split.append(UNIT.findall(MARK + text.replace(" ", MARK)))
        else:
            split.append((MARK + text.replace(" ", " " + MARK)).split(" "))
    if len(pieces._memo) > CACHE:
        pieces._old, pieces._memo = pieces._memo, {}
    memo, old = pieces._memo, pieces._old
    new = set().union(*filter(None, split)) - memo.keys()
    again = new & old.keys()
    memo.update(zip(again, map(old.__getitem__, again)))
    new -= again
    search(new, pieces, memo)
    out = [None if units is None else b"".join(map(memo.__getitem__, units)) for units in split]
    for u in [u for u in new if len(u) > KEPT]:
        del memo[u]
    return out


def encode_text(text: str, pieces: Pieces) -> bytes:
    return encode_texts([text], pieces)[0]


def decode_ids(ids: Iterable[int], pieces: Pieces) -> str:
    """The text of ids; bytes that are no UTF-8 become replacement characters. The space put before a text is taken off."""
    return b"".join(map(pieces.spelled.__getitem__, ids)).decode("utf-8", "replace").removeprefix(" ")


def encode(docs: DataFrame, pieces: Pieces, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, ids`` of every row; null for a null text, an empty list for an empty one. Other columns are not looked at."""
    shared = docs.sparkSession.sparkContext.broadcast(pieces)  # as large as the model file

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = shared.value

        def batch(ids: pa.Array, out: list[bytes | None]) -> pa.RecordBatch:
            ends = np.cumsum([0, *(len(x or b"") // 4 for x in out)]).astype(np.int32)
            offsets = pa.array(ends, mask=np.array([*(x is None for x in out), False]))
            lists = pa.ListArray.from_arrays(offsets, pa.array(np.frombuffer(b"".join(x or b"" for x in out), np.int32)))
            return pa.RecordBatch.from_arrays([ids, lists], names=["id", "ids"])

        for b in batches:
            first, size, texts = 0, 0, []
            for i, t in enumerate(b.column(1)):
                texts.append(t.as_py())
                size += len(texts[-1] or "")
                if size >= FLUSH:
                    yield batch(b.column(0).slice(first, i + 1 - first), encode_texts(texts, p))
                    first, size, texts = i + 1, 0, []
            if texts:
                yield batch(b.column(0).slice(first), encode_texts(texts, p))

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = T.StructType([rows.schema["id"], T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, pieces: Pieces, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """All columns of ``encoded`` and the text of its ids; null for null. An ``out_col`` that is there is replaced."""
    shared = encoded.sparkSession.sparkContext.broadcast(pieces)
    rows = encoded.drop(out_col)
    at = rows.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = shared.value
        for b in batches:
            own = b.column(at)
            ends, flat, there = own.offsets.to_pylist(), own.values.to_numpy(), own.is_valid().to_pylist()
            texts = [decode_ids(flat[lo:hi].tolist(), p) if on else None for lo, hi, on in zip(ends, ends[1:], there)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], names=[*b.schema.names, out_col])

    return rows.mapInArrow(run, T.StructType([*rows.schema, T.StructField(out_col, T.StringType())]))
