"""SentencePiece encoding and decoding with exact N-best segmentation.

A vocabulary file gives pieces and scores; a text's segmentations are the paths of its piece lattice, the better
the greater their sum of scores. Of best paths with equal sums, as scores that are ranks often give, the one counts that has
the longest last piece, then the longest piece before it, and so on. (The scores of a BPE file, as MODEL is, are the order of its merges; the
ids that merging gives, as in the library, are returned beside.) Characters that no piece covers are spelt in byte pieces, as one edge with a
score below all others. A forward Viterbi pass gives each place the best score of reaching it; a backward A*
search from the end takes these scores as its heuristic, which is exact, so complete paths come out best first; of equal
ranks the one nearest to the start is followed, so ties cost no more than a path each.

A text is normalised by the rules in the vocabulary's file (that of MODEL has none), gets a space in front, and spaces are written
as the mark. A lattice is cut where no piece can cross: before a run of marks and, if no piece holds both letters and other signs,
between these. What a text's N best paths lose against the best is the sum of what its stretches' paths lose, so only the N - 1 stretches
whose second best loses least can differ from their best; just these are searched, and the A* goes on over them to whole texts' paths,
whose ids and scores are all returned. Viterbi runs over many new stretches at once, forward, and backward for the second best (the best
path with an edge off the best one). Stretches are kept in a bounded cache; its size changes no result.

Decoding joins pieces, turns marks into spaces and drops the first. It gives every text back from each of its segmentations, the mark itself
included, as that is spelt in bytes when it stands in a text (a text that rules change comes back as they leave it). Nulls: a null text is null in all results; an
empty text has no pieces and score 0. Repeated rows get the same results; other columns are carried in a
struct. Long texts are held whole with the ids of all their segmentations, and a stretch of any length takes memory in proportion.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common as C

#: The vocabulary file, unless spark.vellum.pieces.model names another.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
OWN_MARK = "\0" + MARK
PENALTY = 10.0
#: Stretches that an encoder remembers: some 250 bytes each.
CACHE = 800_000
ENCODED = (("ids", T.ArrayType(T.IntegerType())), ("scores", T.ArrayType(T.DoubleType())), ("others", T.ArrayType(T.ArrayType(T.IntegerType()))), ("merged", T.ArrayType(T.IntegerType())))
OTHER = (("n_pieces", T.LongType()), ("ids_sha256", T.StringType()), ("decoded_sha256", T.StringType()))
DIGESTED = (
    ("n_pieces", T.LongType()), ("ids_sha256", T.StringType()), ("scores", T.ArrayType(T.DoubleType())), ("decoded_bytes", T.LongType()), ("decoded_sha256", T.StringType()),
    ("others", T.ArrayType(T.StructType([T.StructField(*c) for c in OTHER]))), ("merged", T.StructType([T.StructField(*c) for c in OTHER])),
)


class Vocabulary:
    """pieces: (text, score) by id, text None for those that no text holds; bytes_: the id of each byte's piece;
    normalizer: the processor that normalises texts first, None if texts stay as they are but for the space in front;
    prefix: whether there is that space; merging: whether scores are the order in which neighbours merge (BPE)."""

    def __init__(self, pieces: list[tuple[str | None, float]], bytes_: list[int], normalizer=None, prefix: bool = True, merging: bool = False) -> None:
        self.normalizer, self.prefix, self.merging = normalizer, prefix, merging
        self.ids = {p: i for i, (p, _) in enumerate(pieces) if p}
        self.score = [float(s) for _, s in pieces]
        self.bytes = bytes_
        self.spell = [b"" if p is None else p.replace(MARK, " ").encode() for p, _ in pieces]
        for b, i in enumerate(bytes_):
            self.spell[i] = bytes([b])
        self.spelling = np.array(self.spell, object)
        self.longest = max(map(len, self.ids), default=1)
        self.unknown = min((self.score[i] for i in self.ids.values()), default=0.0) - PENALTY
        if any(re.search(f"[^{MARK}]{MARK}", p) for p in self.ids):
            raise ValueError("a piece crosses the start of a word")
        letter = r"[^\W\d_]"
        mixed = any(re.search(f"{letter}(?!{letter})[^{MARK}]|(?!{letter})[^{MARK}]{letter}", p) for p in self.ids)
        self.cut = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+" if mixed else f"{MARK}*{letter}+|{MARK}*(?:(?!{letter})[^{MARK}])+|{MARK}+").findall

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        model = sentencepiece_model_pb2.ModelProto.FromString(sp.serialized_model_proto())
        rules, merging = model.normalizer_spec, model.trainer_spec.model_type == sentencepiece_model_pb2.TrainerSpec.BPE
        changes = bool(rules.precompiled_charsmap) or rules.remove_extra_whitespaces or not rules.add_dummy_prefix
        n = sp.get_piece_size()
        plain = [not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)) for i in range(n)]
        return cls([(sp.id_to_piece(i) if plain[i] else None, sp.get_score(i)) for i in range(n)], [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)], sp if changes else None, rules.add_dummy_prefix, merging)

    def edges(self, s: str, end: int) -> list[tuple[int, float, tuple[int, ...]]]:
        """(start, score, ids) of the edges that end there."""
        out, get = [], self.ids.get
        for start in range(max(0, end - self.longest), end):
            i = get(s[start:end])
            if i is not None:
                out.append((start, self.score[i], (i,)))
        if not out or out[-1][0] != end - 1:
            out.append((end - 1, self.unknown, tuple(self.bytes[b] for b in s[end - 1].encode())))
        return out

    def nbest(self, s: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """The n best segmentations of a stretch (all, if fewer), with their scores, best first."""
        if not s:
            return [(0.0, ())]
        best: list[float] = [0.0] * (len(s) + 1)  # forward Viterbi
        came: list[tuple[int, tuple[int, ...]]] = [(0, ())] * (len(s) + 1)
        into = [self.edges(s, end) if end else [] for end in range(len(s) + 1)]
        for end in range(1, len(s) + 1):
            score, _, start, ids = max((best[start] + score, -start, start, ids) for start, score, ids in into[end])
            best[end], came[end] = score, (start, ids)
        path, at = [], len(s)
        while at:
            path.append(came[at][1])
            at = came[at][0]
        first = tuple(i for ids in reversed(path) for i in ids)
        out = [(best[len(s)], first)]
        if n == 1:
            return out
        heap = [(-best[len(s)], len(s), 0, 0.0, None)]  # backward A*: behind an end, best is what is still to come
        pushed, skipped = 0, False
        while heap and len(out) < n:
            rank, at, _, behind, path = heapq.heappop(heap)
            if not at:
                ids = []
                while path is not None:
                    ids += path[0]
                    path = path[1]
                if not skipped and tuple(ids) == first:  # it is in the list already
                    skipped = True
                else:
                    out.append((-rank, tuple(ids)))
                continue
            for start, score, ids_ in into[at]:
                pushed += 1
                heapq.heappush(heap, (-(best[start] + score + behind), start, pushed, behind + score, (ids_, path)))
        return out

    def merged(self, s: str) -> tuple[int, ...]:
        """The ids of a stretch by merges: of all neighbours that form a piece those of the best score merge first, the leftmost of equal ones."""
        n, heap = len(s), []
        end, start = [*range(1, n + 1), n], [0, *range(n)]  # of the symbol that starts, or ends, at a place

        def offer(a: int, m: int, b: int) -> None:
            i = self.ids.get(s[a:b]) if b - a <= self.longest else None
            if i is not None:
                heapq.heappush(heap, (-self.score[i], a, m, b))

        for a in range(n - 1):
            offer(a, a + 1, a + 2)
        while heap:
            _, a, m, b = heapq.heappop(heap)
            if end[a] != m or end[m] != b:
                continue
            end[a], end[m], start[b] = b, -1, a
            if a:
                offer(start[a], a, b)
            if b < n:
                offer(a, b, end[b])
        out, at = [], 0
        while at < n:
            i = self.ids.get(s[at : end[at]])
            out += [i] if i is not None else [self.bytes[b] for b in s[at].encode()]
            at = end[at]
        return tuple(out)

    def stretches(self, text: str) -> list[str]:
        """The parts of a text, spaces as marks, between which no piece can lie. A mark of the text itself is a
        part alone, OWN_MARK."""
        if self.normalizer is not None:
            return self.cut(self.normalizer.normalize(text))
        if not text:
            return []
        if MARK not in text:
            return self.cut(MARK + text.replace(" ", MARK))
        out: list[str] = []
        for k, between in enumerate((" " + text).split(MARK)):
            out += [OWN_MARK] * (k > 0) + self.cut(between.replace(" ", MARK))
        return out


class Lookup:
    """Piece ids of many strings at once, by 64-bit hashes of their code points; pieces whose slot is taken are
    in a short sorted list."""

    BASE, BITS = np.uint64(0x9E3779B97F4A7C15), 20

    def __init__(self, v: Vocabulary) -> None:
        items = sorted(v.ids.items())
        keys = np.array([self.hash_one(p) for p, _ in items], np.uint64)
        ids = np.array([i for _, i in items], np.int64)
        slots = self.slot(keys)
        _, first = np.unique(slots, return_index=True)
        self.key, self.id = np.zeros(1 << self.BITS, np.uint64), np.full(1 << self.BITS, -1, np.int64)
        self.key[slots[first]], self.id[slots[first]] = keys[first], ids[first]
        late = np.setdiff1d(np.arange(len(keys)), first)
        late = late[np.argsort(keys[late])]
        self.late_key, self.late_id = keys[late], ids[late]
        self.shared = np.zeros(1 << self.BITS, bool)
        self.shared[slots[late]] = True

    @classmethod
    def hash_one(cls, s: str) -> int:
        h = 0
        for c in s:
            h = (h * int(cls.BASE) + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
        return h

    def slot(self, h: np.ndarray) -> np.ndarray:
        return C.mix(h) >> np.uint64(64 - self.BITS)

    def find(self, h: np.ndarray) -> np.ndarray:
        slots = self.slot(h)
        out = np.where(self.key[slots] == h, self.id[slots], -1)
        again = np.flatnonzero((self.shared[slots] & (out < 0)).ravel())
        if len(again):
            x = h.ravel()[again]
            at = np.minimum(np.searchsorted(self.late_key, x), len(self.late_key) - 1)
            out.ravel()[again] = np.where(self.late_key[at] == x, self.late_id[at], -1)
        return out


class Places(dict):
    """Stretches by number, in the order in which they are first asked for; new ones are noted."""

    def __init__(self) -> None:
        self.new: list[str] = []

    def __missing__(self, s: str) -> int:
        self[s] = at = len(self)
        self.new.append(s)
        return at


def _more(x: np.ndarray, n: int) -> np.ndarray:
    """x with room for n elements at least."""
    if n <= len(x):
        return x
    out = np.zeros(max(n, len(x) * 3 // 2, 1 << 12), x.dtype)
    out[: len(x)] = x
    return out


class Ids:
    """Lists of ids by number, end to end in one array."""

    def __init__(self) -> None:
        self.data, self.used = np.zeros(0, np.int32), 0
        self.start, self.size = np.zeros(0, np.int64), np.zeros(0, np.int32)

    def put(self, at: np.ndarray, sizes: np.ndarray, data: np.ndarray) -> None:
        self.data = _more(self.data, self.used + len(data))
        self.data[self.used : self.used + len(data)] = data
        most = int(at.max(initial=-1)) + 1
        self.start, self.size = _more(self.start, most), _more(self.size, most)
        self.start[at], self.size[at] = self.used + np.cumsum(sizes) - sizes, sizes
        self.used += len(data)

    def take(self, at: np.ndarray) -> np.ndarray:
        """The lists of these numbers, joined; in parts, as an index takes more than the ids."""
        out = [self.data[:0]]
        for part in (at[lo : lo + (1 << 18)] for lo in range(0, len(at), 1 << 18)):
            sizes = self.size[part].astype(np.int64)
            ends = np.cumsum(sizes)
            out.append(self.data[np.repeat(self.start[part] - ends + sizes, sizes) + np.arange(ends[-1])])
        return np.concatenate(out)


class Encoder:
    """Encodes texts, remembering stretches: the best segmentation of each and the loss of its second best, and that by merges.
    The other segmentations are searched for only in stretches that a text's N best need."""

    def __init__(self, vocabulary: Vocabulary, n: int) -> None:
        self.v, self.n, self.lookup = vocabulary, n, Lookup(vocabulary)
        self.score = np.array(vocabulary.score)
        self.clear()

    def clear(self) -> None:
        self.at = Places()
        self.best, self.merges = Ids(), Ids()
        self.scores, self.least = np.zeros(0), np.zeros(0)
        self.others: dict[str, list[tuple[float, bytes]]] = {}

    def learn(self) -> None:
        """Forward Viterbi over all new stretches of a length together, and backward for the second best."""
        stretches, self.at.new = self.at.new, []
        self.scores, self.least = _more(self.scores, len(self.at)), _more(self.least, len(self.at))
        by_length: dict[int, list[str]] = {}
        for s in stretches:
            by_length.setdefault(len(s) if len(s) <= 64 and "\0" not in s else 0, []).append(s)
        for length, group in by_length.items():
            for lo in range(0, len(group), 2048):
                part = group[lo : lo + 2048]
                if length:
                    self._many(part, length)
                    continue
                for s in part:
                    found = self._search(s)
                    at = self.at[s]
                    self.scores[at], self.least[at] = found[0][0], found[0][0] - found[1][0] if len(found) > 1 else np.inf
                    self._put(self.best, [at], [found[0][1]])
                    if self.v.merging:
                        self._put(self.merges, [at], [found[0][1] if s == OWN_MARK else self.v.merged(s)])

    def _put(self, where: Ids, at: Iterable[int], lists: list[Iterable[int]]) -> None:
        where.put(np.array(at, np.int64), np.array([len(x) for x in lists], np.int64), np.array([i for x in lists for i in x], np.int32))

    def _search(self, s: str) -> list[tuple[float, tuple[int, ...]]]:
        if s == OWN_MARK:
            return [(self.v.unknown, tuple(self.v.bytes[b] for b in MARK.encode()))]
        return self.v.nbest(s, self.n)

    def _many(self, group: list[str], length: int) -> None:
        chars = np.array(group, f"U{length}").view(np.uint32).reshape(len(group), length).astype(np.uint64)
        n, none = len(group), -np.inf
        ids, gain, h = [], [], np.zeros((n, length), np.uint64)
        for size in range(1, min(length, self.v.longest) + 1):
            h = h[:, : length - size + 1] * Lookup.BASE + chars[:, size - 1 :] + np.uint64(1)
            found = self.lookup.find(h)
            ids.append(found)
            gain.append(np.where(found >= 0, self.score[found], self.v.unknown if size == 1 else none))
        ahead, back = np.full((n, length + 1), none), np.full((n, length + 1), none)
        ahead[:, 0] = back[:, length] = 0
        step = np.zeros((n, length + 1), np.int64)
        for end in range(1, length + 1):
            for size in range(1, min(end, len(ids)) + 1):
                x = ahead[:, end - size] + gain[size - 1][:, end - size]
                better = (x >= ahead[:, end]) & (x > none)  # of equal ones the longest
                ahead[better, end] = x[better]
                step[better, end] = size
        for start in range(length - 1, -1, -1):
            for size in range(1, min(length - start, len(ids)) + 1):
                np.maximum(back[:, start], gain[size - 1][:, start] + back[:, start + size], out=back[:, start])
        path, rows = np.full((n, length), -2, np.int64), np.arange(n)
        at, column = np.full(n, length), length
        on = [np.zeros(x.shape, bool) for x in ids]
        while (live := at > 0).any():
            column -= 1
            size = step[rows, at]
            for k in np.unique(size[live]):
                r = rows[live & (size == k)]
                path[r, column] = ids[k - 1][r, at[r] - k]
                on[k - 1][r, at[r] - k] = True
                at[r] -= k
        second = np.full(n, none)  # another path has an edge off the best one
        for k, (g, used) in enumerate(zip(gain, on, strict=True)):
            through = ahead[:, : length - k] + g + back[:, k + 1 :]
            through[used] = none
            np.maximum(second, through.max(axis=1), out=second)
        total = ahead[:, length]
        at = np.fromiter(map(self.at.__getitem__, group), np.int64, n)
        self.scores[at], self.least[at] = total, total - second
        here = path > -2  # the paths' ends are aligned
        odd = (path == -1).any(axis=1)
        self.best.put(at[~odd], here[~odd].sum(axis=1), path[here & ~odd[:, None]])
        spelt = []
        for r in np.flatnonzero(odd).tolist():
            steps, e = [], length
            while e:
                steps.append((e - int(step[r, e]), e))
                e -= int(step[r, e])
            spelt.append(self._spelt(group[r], ids, r, reversed(steps)))
        self._put(self.best, at[odd], spelt)
        if self.v.merging:
            self._merge(group, length, at, ids)

    def _spelt(self, s: str, ids: list[np.ndarray], r: int, steps: Iterable[tuple[int, int]]) -> list[int]:
        """The ids of a path, bytes where no piece is."""
        out = []
        for a, b in steps:
            i = int(ids[b - a - 1][r, a])
            out += [i] if i >= 0 else [self.v.bytes[x] for x in s[a:b].encode()]
        return out

    def _merge(self, group: list[str], length: int, at: np.ndarray, ids: list[np.ndarray]) -> None:
        """Vocabulary.merged of many stretches of a length, a merge of each at a time."""
        n, most, none = len(group), len(ids), -np.inf
        piece = np.full((most + 1, n, length), -1, np.int32)  # by size, row and start
        for k, x in enumerate(ids):
            piece[k + 1, :, : length - k] = x
        score = lambda size, r, a: np.where((i := piece[np.where(size <= most, size, 0), r, a]) >= 0, self.score[i], none)
        rows, live = np.arange(n), np.ones((n, length), bool)
        end, start = np.tile(np.arange(1, length + 2), (n, 1)), np.tile(np.arange(-1, length), (n, 1))
        pair = np.full((n, length), none)  # score of the symbol at a place with the next one
        for a in range(length - 1):
            pair[:, a] = score(np.full(n, 2), rows, np.full(n, a))
        while True:
            a = pair.argmax(axis=1)  # of equal ones the leftmost
            r = np.flatnonzero(pair[rows, a] > none)
            if not len(r):
                break
            a = a[r]
            m = end[r, a]
            b = end[r, m]
            end[r, a], start[r, b], live[r, m], pair[r, m] = b, a, False, none
            last = b == length
            pair[r, a] = np.where(last, none, score(end[r, b] - a, r, a))
            left = np.flatnonzero(a > 0)
            r, a, b = r[left], a[left], b[left]
            before = start[r, a]
            pair[r, before] = score(b - before, r, before)
        r, a = np.nonzero(live)
        found, sizes = piece[end[r, a] - a, r, a], live.sum(axis=1)
        odd = np.zeros(n, bool)
        odd[r[found < 0]] = True
        self.merges.put(at[~odd], sizes[~odd], found[~odd[r]])
        spelt = [self._spelt(group[k], ids, k, [(x, int(end[k, x])) for x in np.flatnonzero(live[k]).tolist()]) for k in np.flatnonzero(odd).tolist()]
        self._put(self.merges, at[odd], spelt)

    def nbest_all(self, texts: list[str | None]) -> list[list[tuple[float, bytes]] | None]:
        """For each text its n best segmentations (all, if fewer), best first: score, and ids as little-endian int32."""
        return [found and found[0] for found in self.all(texts)]

    def all(self, texts: list[str | None]) -> list[tuple[list[tuple[float, bytes]], bytes | None] | None]:
        """nbest_all, each with the ids by merges, None if the vocabulary has no merges."""
        if len(self.at) > CACHE:
            self.clear()
        split = [None if text is None else self.v.stretches(text) for text in texts]
        rows = [None if parts is None else np.fromiter(map(self.at.__getitem__, parts), np.int64, len(parts)) for parts in split]
        self.learn()
        merged = lambda at: self.merges.take(at).tobytes() if self.v.merging else None
        return [None if parts is None else (self._nbest(parts, at), merged(at)) for parts, at in zip(split, rows, strict=True)]

    def encode_all(self, texts: list[str | None]) -> list[tuple[bytes, list[float]] | None]:
        """For each text, the ids of its best segmentation as little-endian int32 and the scores of its n best."""
        return [found and (found[0][1], [x for x, _ in found]) for found in self.nbest_all(texts)]

    def encode(self, text: str) -> tuple[bytes, list[float]]:
        return self.encode_all([text])[0]

    def _losing(self, s: str) -> list[tuple[float, bytes]]:
        """The n best segmentations of a stretch as ids, with what each loses against the best."""
        if s not in self.others:
            found = self._search(s)
            self.others[s] = [(found[0][0] - x, np.array(ids, np.int32).tobytes()) for x, ids in found]
        return self.others[s]

    def _nbest(self, parts: list[str], rows: np.ndarray) -> list[tuple[float, bytes]]:
        best = self.best.take(rows).tobytes()
        total = float(self.scores[rows].sum()) if len(rows) else 0.0
        if self.n == 1 or not len(rows):
            return [(total, best)]
        least = self.least[rows]
        most = np.partition(least, min(self.n, len(rows)) - 1)[min(self.n, len(rows)) - 1]
        near = np.flatnonzero(least <= most)
        near = np.sort(near[np.argsort(least[near], kind="stable")][: self.n - 1])
        ends = (4 * np.cumsum(self.best.size[rows], dtype=np.int64))[near].tolist()
        choices = [self._losing(parts[i]) for i in near.tolist()]
        out: list[tuple[float, bytes]] = []
        heap = [(0.0, len(near), 0, None)]  # backward A* over the stretches: before the places passed, all can be the best
        pushed = 0
        while heap and len(out) < self.n:
            loss, at, _, changes = heapq.heappop(heap)
            if not at:
                ids, done = [], 0
                while changes is not None:
                    (k, other), changes = changes
                    ids += [best[done : ends[k] - len(choices[k][0][1])], other]
                    done = ends[k]
                out.append((total - loss, b"".join([*ids, best[done:]]) if ids else best))
                continue
            for x, other in choices[at - 1]:
                heapq.heappush(heap, (loss + x, at - 1, pushed, ((at - 1, other), changes) if other is not choices[at - 1][0][1] else changes))
                pushed += 1
        return out


def decode(vocabulary: Vocabulary, ids: bytes) -> str:
    """The text that was encoded, normalised if the vocabulary's file says so."""
    return b"".join(vocabulary.spelling[np.frombuffer(ids, np.int32)].tolist())[vocabulary.prefix :].decode(errors="replace")


def vocabulary(spark, model: str | None = None):
    """The broadcast vocabulary of a file, some MB at most."""
    return spark.sparkContext.broadcast(Vocabulary.load(model or spark.conf.get("spark.vellum.pieces.model", MODEL)))


def encode(df: DataFrame, text_col: str = "text", n: int = 4, carry: list[str] | None = None, model: str | None = None) -> DataFrame:
    """(row, ids, scores, others, merged) for each row of df: row a struct of its columns in carry (all by default), the ids of
    its best segmentation, the scores of its n best, the ids of the second to the n-th best, and the ids by merges (null if the
    vocabulary has none)."""
    held, source = vocabulary(df.sparkSession, model), _source(df, text_col, carry)
    return source.mapInArrow(_encoding(held, n), _schema(source, ENCODED))


def _source(df: DataFrame, text_col: str, carry: list[str] | None) -> DataFrame:
    return df.select(F.struct(*[F.col(f"`{c}`") for c in (df.columns if carry is None else carry)]).alias("row"), F.col(f"`{text_col}`").cast("string").alias("text"))


def _schema(source: DataFrame, columns: tuple[tuple[str, T.DataType], ...]) -> T.StructType:
    return T.StructType([source.schema["row"], *(T.StructField(c, t) for c, t in columns)])


def _lists(sizes: list[int | None], values: pa.Array) -> pa.ListArray:
    """Lists of these sizes, null where None, that share out the values in order."""
    off = np.append(0, np.cumsum([size or 0 for size in sizes])).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(off, mask=np.array([size is None for size in sizes] + [False])), values)


def _id_lists(found: list[bytes | None]) -> pa.ListArray:
    return _lists([None if ids is None else len(ids) // 4 for ids in found], pa.array(np.frombuffer(b"".join(ids for ids in found if ids), np.int32)))


def _structs(rows: list[tuple[int, str, str] | None]) -> pa.StructArray:
    parts = [pa.array([x and x[k] for x in rows], t) for k, t in enumerate((pa.int64(), pa.string(), pa.string()))]
    return pa.StructArray.from_arrays(parts, names=[c for c, _ in OTHER], mask=pa.array([x is None for x in rows], pa.bool_()))


def _encoding(held, n: int):
    """Batches (row, text) -> (row, ids, scores, others, merged)."""

    @C.lean
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(held.value, n)
        for block in C.blocks(batches):
            both = encoder.all(block.column("text").to_pylist())
            found, merged = [x and x[0] for x in both], _id_lists([x and x[1] for x in both])
            ids = _id_lists([x and x[0][1] for x in found])
            scores = pa.array([x and [score for score, _ in x] for x in found], pa.list_(pa.float64()))
            others = _lists([x and len(x) - 1 for x in found], _id_lists([ids for x in found if x for _, ids in x[1:]]))
            yield pa.RecordBatch.from_arrays([block.column("row"), ids, scores, others, merged], names=["row", *(c for c, _ in ENCODED)])

    return work


def _digesting(held):
    """Batches of encode() -> those of digests()."""

    known: dict[str, tuple[int, str]] = {}  # of the last text decoded: a row's segmentations mostly decode to one text

    def digest(ids: pa.ListScalar) -> tuple[int, str, int, str]:
        raw = ids.values.to_numpy().astype(np.int32, copy=False).tobytes()
        text = decode(held.value, raw)
        if text not in known:
            known.clear()
            known[text] = len(data := text.encode()), hashlib.sha256(data).hexdigest()
        return len(raw) // 4, hashlib.sha256(raw).hexdigest(), *known[text]

    @C.lean
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best, others, merged = [], [], []
            for ids, found, joined in zip(batch.column("ids"), batch.column("others"), batch.column("merged"), strict=True):
                best.append(digest(ids) if ids.is_valid else (None,) * 4)
                others.append([(k, a, b) for k, a, _, b in map(digest, found.values)] if found.is_valid else None)
                merged += [(k, a, b) for k, a, _, b in [digest(joined)]] if joined.is_valid else [None]
            n, ids_sha, size, sha = zip(*best, strict=True) if best else ((),) * 4
            columns = [batch.column("row"), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), batch.column("scores"), pa.array(size, pa.int64()), pa.array(sha, pa.string())]
            columns += [_lists([None if x is None else len(x) for x in others], _structs([x for found in others if found for x in found])), _structs(merged)]
            yield pa.RecordBatch.from_arrays(columns, names=["row", *(c for c, _ in DIGESTED)])

    return work


def digests(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """(row, n_pieces, ids_sha256, scores, decoded_bytes, decoded_sha256, others, merged): what encode() returned, decoded again;
    others has (n_pieces, ids_sha256, decoded_sha256) of each further segmentation, merged of that by merges."""
    return encoded.mapInArrow(_digesting(vocabulary(encoded.sparkSession, model)), _schema(encoded, DIGESTED))


def encoded_digests(df: DataFrame, text_col: str = "text", n: int = 4, carry: list[str] | None = None, model: str | None = None) -> DataFrame:
    """digests(encode(df, ...)) with one vocabulary and one worker for each task: ids don't leave it."""
    held, source = vocabulary(df.sparkSession, model), _source(df, text_col, carry)
    encoding, digesting = _encoding(held, n), _digesting(held)
    return source.mapInArrow(lambda batches: digesting(encoding(batches)), _schema(source, DIGESTED))


def op5_pieces(spark, sf_dir: str) -> DataFrame:
    out = encoded_digests(C.table(spark, sf_dir, "documents"), carry=["doc_id"])
    best = [F.get("scores", F.lit(k)).alias(f"score{k + 1}") for k in range(4)]
    others = [F.get("others", F.lit(k))[c].alias(c.replace("_", f"{k + 2}_", 1) if c != "n_pieces" else f"{c}{k + 2}") for k in range(3) for c, _ in OTHER]
    return out.select("row.doc_id", "n_pieces", "ids_sha256", *best, "decoded_bytes", "decoded_sha256", *others, *[F.col(f"merged.{c}").alias(f"merged_{c}") for c, _ in OTHER])
