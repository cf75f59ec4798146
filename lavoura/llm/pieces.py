"""N-best segmentation into the pieces of a SentencePiece model, and decoding.

A text's lattice has a node between any two characters and an edge for every piece that spells
the characters between two nodes. Forward Viterbi scores give the best way to every node; they
are exact estimates of what is left for a search that starts at the end, so A-star finds the
segmentations in order of their scores.

No piece runs on over a blank that follows a letter or over a line break, so the lattice falls
apart into short stretches. Forward scores of many stretches are computed side by side; the
best and second-best segmentation of a text is put together from those of its stretches, and
A-star runs on the few stretches whose alternatives can be among a text's ``n`` best.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lavoura.llm.common import CACHE_BYTES, ENTRY_BYTES, in_use

SPACE = "▁"
#: Longest stretch whose lattice is worked on side by side with others; longer ones, one by one, come out the same.
COLUMNS = 48
#: Texts segmented together, and told together with the ids and texts of all their segmentations.
TEXTS, TOLD_TEXTS = 1024, 128
_BASE = 0x9E3779B97F4A7C15


class Pieces:
    """The pieces of a model: ids, scores, and what each one spells.

    Characters without a piece are spelled by byte pieces, at the price of one unknown piece: 10
    less than the lowest score. So is U+2581 itself, which stands for a blank in pieces.
    """

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.ids: dict[str, int] = {}
        self.score: list[float] = []
        self.spelled: list[bytes] = []
        self.bytes = [0] * 256
        for i in range(model.get_piece_size()):
            piece, plain = model.id_to_piece(i), False
            if model.is_byte(i):
                self.bytes[int(piece[1:-1], 16)] = i
                self.spelled.append(bytes([int(piece[1:-1], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.spelled.append(b"")
            else:
                plain = True
                self.spelled.append(piece.replace(SPACE, " ").encode())
            self.score.append(model.get_score(i))
            if plain and "\n" not in piece and SPACE not in piece.lstrip(SPACE):
                self.ids[piece.replace(SPACE, " ")] = i
        # Marks that no piece has after a letter: the lattice falls apart before them, too.
        joined = {b for x in self.ids for a, b in zip(x, x[1:], strict=False) if a.isalpha()}
        marks = "".join(re.escape(c) for c in "!\"#$%&()*+,-./:;<=>?@[]_{|}~" if c not in joined)
        plain = f" *+[^\\W\\d_]++(?=[{marks}])|" if marks else ""
        self.stretch = re.compile(plain + " +[^ \\n]*|\\n|[^ \\n]+")
        self.unknown = min(self.score) - 10
        self.longest = max(map(len, self.ids))
        # Pieces by a hash of their characters, in tables of which each takes what the last left.
        names = list(self.ids)
        keys = np.array([self._hash(np.array([ord(c) for c in x], np.uint64)[None, :])[0] for x in names], np.uint64)
        numbers = np.array([self.ids[x] for x in names], np.int32)
        self.tables = []
        while len(keys):
            slot = self._slot(keys, len(self.tables))
            key, number = np.zeros(1 << 17, np.uint64), np.full(1 << 17, -1, np.int32)
            key[slot], number[slot] = keys, numbers
            left = number[slot] != numbers
            more = np.zeros(1 << 17, bool)  # slots of which the next table has more
            more[slot[left]] = True
            self.tables.append((key, number, more))
            keys, numbers = keys[left], numbers[left]
        self.score_of = np.append(np.array(self.score), -np.inf)  # the last for "no piece"
        self.spelled_flat = np.frombuffer(b"".join(self.spelled), np.uint8)
        self.spelled_length = np.array([len(x) for x in self.spelled], np.int64)
        self.spelled_start = np.cumsum(self.spelled_length) - self.spelled_length

    @staticmethod
    def _hash(chars: np.ndarray) -> np.ndarray:
        """Hash of each row of characters."""
        h = np.zeros(len(chars), np.uint64)
        for j in range(chars.shape[1]):
            h = (h ^ chars[:, j]) * np.uint64(_BASE)
            h ^= h >> np.uint64(29)
        return h

    @staticmethod
    def _slot(keys: np.ndarray, table: int) -> np.ndarray:
        return ((keys * np.uint64(2 * table + 0xBF58476D1CE4E5B9)) >> np.uint64(47)).astype(np.int64)

    def _lookup(self, keys: np.ndarray) -> np.ndarray:
        """Ids of hashed strings, -1 for no piece."""
        out = np.full(len(keys), -1, np.int32)
        rest = np.arange(len(keys))
        for t, (key, number, more) in enumerate(self.tables):
            slot = self._slot(keys[rest], t)
            hit = key[slot] == keys[rest]
            out[rest[hit]] = number[slot[hit]]
            rest = rest[~hit & more[slot]]
            if not len(rest):
                break
        return out

    # ---- one stretch -----------------------------------------------------------------------

    def edges_to(self, text: str, end: int) -> list[tuple[int, float]]:
        """(start, score) of the pieces that end at a place, longest first."""
        found = []
        for start in range(max(0, end - self.longest), end):
            if (i := self.ids.get(text[start:end])) is not None:
                found.append((start, self.score[i]))
        if text[end - 1] not in self.ids:
            found.append((end - 1, self.unknown))
        return found

    def ids_of(self, piece: str) -> list[int]:
        """The piece's id; a character without one is spelled in bytes."""
        return [self.ids[piece]] if piece in self.ids else [self.bytes[b] for b in piece.encode()]

    def n_best(self, text: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """The ``n`` best segmentations of a stretch: (score, ids), best first.

        At equal scores the one with the longer last piece comes first, then that with the longer
        piece before it, and so on.

        Forward Viterbi, then A-star from the end: a partial segmentation is valued by its own
        score and the forward score of the place it has reached, which is exactly what the rest
        will add at best. So the best partial one always leads to a whole one of that value. Partial
        segmentations are nodes of a tree with links towards the end; the open ones are its missing
        children, in the order of the tree, which is the order at equal scores.
        """
        known: dict[int, list[tuple[int, float]]] = {}

        def edges_to(end: int) -> list[tuple[int, float]]:
            if len(text) > COLUMNS:  # those of a long stretch are not held
                return self.edges_to(text, end)
            if end not in known:
                known[end] = self.edges_to(text, end)
            return known[end]

        forward = [0.0]
        for end in range(1, len(text) + 1):
            forward.append(max([forward[start] + score for start, score in edges_to(end)]))
        place, score, parent = [len(text)], [0.0], [-1]
        child: dict[tuple[int, int], int] = {}

        def added(node: int, start: int, more: float) -> int:
            child[node, start] = len(place)
            place.append(start)
            score.append(score[node] + more)
            parent.append(node)
            return len(place) - 1

        def leaf(node: int) -> int:
            while place[node]:
                values = [(forward[start] + more, -start, more) for start, more in edges_to(place[node])]
                _, start, more = max(values)
                node = added(node, -start, more)
            return node

        found, best = [leaf(0)], None
        while len(found) < n:
            best = None  # value, node, start, score of the piece
            walk = [(0, iter(edges_to(len(text))))]
            while walk:
                node, edges = walk[-1]
                for start, more in edges:
                    if (below := child.get((node, start))) is not None:
                        if start:
                            walk.append((below, iter(edges_to(start))))
                        break
                    value = forward[start] + (score[node] + more)
                    if best is None or value > best[0]:
                        best = (value, node, start, more)
                else:
                    walk.pop()
            if best is None or best[0] == -np.inf:
                break
            found.append(leaf(added(*best[1:])))
        out = []
        for node in found:
            ids: list[int] = []
            total = score[node]
            while parent[node] >= 0:
                ids += self.ids_of(text[place[node] : place[parent[node]]])
                node = parent[node]
            out.append((float(total), tuple(ids)))
        return out

    # ---- many stretches ---------------------------------------------------------------------

    def best(self, stretches: list[str]) -> list[tuple[bytes, float, float]]:
        """(ids as little-endian 32-bit integers, score, loss to the second best) of each."""
        ids, count, score, loss = self.best_columns(stretches)
        ends = np.cumsum(count)
        return [(ids[e - c : e].tobytes(), t, x) for e, c, t, x in zip(ends, count, score.tolist(), loss.tolist(), strict=True)]

    def best_columns(self, stretches: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The ids of the best segmentations, one after the other, and of each its number of ids,
        its score and its loss to the second best."""
        by_length: dict[int, list[int]] = {}
        for i, s in enumerate(stretches):
            by_length.setdefault(len(s), []).append(i)
        found, order = [], []
        for length, rows in by_length.items():
            order += rows
            if length > COLUMNS:
                for i in rows:
                    two = self.n_best(stretches[i], 2)
                    loss = two[0][0] - two[1][0] if len(two) > 1 else np.inf
                    found.append(tuple(np.array(x) for x in (two[0][1], [len(two[0][1])], [two[0][0]], [loss])))
                continue
            for at in range(0, len(rows), 4096):
                found.append(self._side_by_side([stretches[i] for i in rows[at : at + 4096]], length))
        if not found:
            return np.zeros(0, "<i4"), np.zeros(0, np.int64), np.zeros(0), np.zeros(0)
        ids, count, score, loss = (np.concatenate(x) for x in zip(*found, strict=True))
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        starts = np.cumsum(count) - count
        return _spans(ids.astype("<i4"), starts[back], count[back]), count[back], score[back], loss[back]

    def _side_by_side(self, stretches: list[str], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        n = len(stretches)
        chars = np.frombuffer("".join(stretches).encode("utf-32-le"), "<u4").reshape(n, length).astype(np.uint64)
        own = {}  # (start, end) -> ids, -1 for none, -2 for an unknown character
        score = {}
        for start in range(length):
            h = np.zeros(n, np.uint64)
            for end in range(start + 1, min(length, start + self.longest) + 1):
                h = (h ^ chars[:, end - 1]) * np.uint64(_BASE)
                h ^= h >> np.uint64(29)
                ids = self._lookup(h)
                if end == start + 1:
                    ids[ids < 0] = -2
                if (ids != -1).any():
                    own[start, end] = ids
                    score[start, end] = np.where(ids == -2, self.unknown, self.score_of[ids])
        forward = np.full((length + 1, n), -np.inf)
        backward = np.full((length + 1, n), -np.inf)
        forward[0], backward[length] = 0, 0
        came = np.zeros((length + 1, n), np.int64)
        for end in range(1, length + 1):
            for start in range(max(0, end - self.longest), end):
                if (start, end) in own:
                    value = forward[start] + score[start, end]
                    better = value > forward[end]
                    forward[end][better], came[end][better] = value[better], start
        for start in range(length - 1, -1, -1):
            for end in range(start + 1, min(length, start + self.longest) + 1):
                if (start, end) in own:
                    np.maximum(backward[start], backward[end] + score[start, end], out=backward[start])
        # The best way, backwards; then the best one with an edge that is not on it.
        on_way = np.zeros((length + 1, n), bool)
        on_way[length] = True
        ids, count, rows = np.zeros((n, length), "<i4"), np.zeros(n, np.int64), np.arange(n)
        before = np.full((length + 1, n), -1)
        for end in range(length, 0, -1):
            here = on_way[end]
            before[end, here] = came[end, here]
            on_way[came[end, here], rows[here]] = True
            for start in range(max(0, end - self.longest), end):
                if (start, end) in own and len(some := np.flatnonzero(before[end] == start)):
                    ids[some, length - 1 - count[some]] = own[start, end][some]
                    count[some] += 1
        second = np.full(n, -np.inf)
        for (start, end), value in score.items():
            way = forward[start] + value + backward[end]
            np.maximum(second, np.where(before[end] == start, -np.inf, way), out=second)
        total, spelled = forward[length], np.arange(length) >= length - count[:, None]
        strange = np.flatnonzero((ids == -2).any(axis=1))
        if not len(strange):
            return ids[spelled], count, total, total - second
        each = np.split(ids[spelled], np.cumsum(count)[:-1])
        for r in strange.tolist():
            each[r] = self._in_bytes(stretches[r], each[r].tolist(), np.flatnonzero(on_way[:length, r]).tolist())
        return np.concatenate(each), np.array([len(x) for x in each]), total, total - second

    def _in_bytes(self, stretch: str, ids: list[int], starts: list[int]) -> np.ndarray:
        """``ids`` of pieces that begin at ``starts``, unknown characters as bytes."""
        out: list[int] = []
        for i, start in zip(ids, starts, strict=True):
            out += [i] if i >= 0 else [self.bytes[b] for b in stretch[start].encode()]
        return np.array(out, "<i4")

    # ---- decoding ------------------------------------------------------------------------------

    def spell(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes that ids spell, and where those of each begin; the last place is their end."""
        length = self.spelled_length[ids]
        return _spans(self.spelled_flat, self.spelled_start[ids], length), np.concatenate([[0], np.cumsum(length)])

    def decode(self, ids: np.ndarray) -> bytes:
        """The text that ids spell, without the blank that encoding puts before it."""
        return self.spell(ids)[0].tobytes()[1:]


def _spans(values: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """``length`` values from each ``start`` on, one after the other."""
    ends = np.cumsum(length)
    return values[np.repeat(start - (ends - length), length) + np.arange(ends[-1] if len(ends) else 0)]


class Segmenter(dict):
    """Cached best segmentations of stretches, and ``n`` best ones of whole texts.

    It numbers the stretches; columns hold their segmentations under these numbers. When it is full,
    the half that was used more often stays.
    """

    def __init__(self, path: str):
        super().__init__()
        self.pieces = Pieces(path)
        self.lists: dict[tuple[str, int], list[tuple[float, bytes, bytes]]] = {}
        self.clear()

    def clear(self) -> None:
        super().clear()
        self.lists.clear()
        self.names: list[str] = []
        self.ids = np.zeros(0, "<i4")
        self.start, self.count, self.uses = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.score, self.loss = np.zeros(0), np.zeros(0)
        self.held = self.listed = 0

    def _add(self, names: list[str], ids: np.ndarray, count: np.ndarray, score: np.ndarray, loss: np.ndarray, uses: np.ndarray) -> None:
        self.update(zip(names, range(len(self), len(self) + len(names)), strict=True))
        self.names += names
        self.start = np.concatenate([self.start, len(self.ids) + np.cumsum(count) - count])
        self.ids, self.count = np.concatenate([self.ids, ids]), np.concatenate([self.count, count])
        self.score, self.loss = np.concatenate([self.score, score]), np.concatenate([self.loss, loss])
        self.uses = np.concatenate([self.uses, uses])
        self.held += ENTRY_BYTES * len(names) + sum(map(len, names)) + 4 * len(ids)

    def _halve(self) -> None:
        stay = np.argsort(-self.uses, kind="stable")[: len(self) // 2]
        names, ids = [self.names[i] for i in stay.tolist()], _spans(self.ids, self.start[stay], self.count[stay])
        columns = [x[stay] for x in (self.count, self.score, self.loss)]
        uses = self.uses[stay] // 2
        self.clear()
        self._add(names, ids, *columns, uses)

    def numbers(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of the stretches of all texts, and where those of each text begin; the last place is their end."""
        in_use(self)
        split = [self.pieces.stretch.findall(f" {t}") if t else [] for t in texts]
        while self.held > CACHE_BYTES and len(self):
            self._halve()
        at, flat = np.cumsum([0, *map(len, split)]), list(chain.from_iterable(split))
        found = np.fromiter(map(self.get, flat, repeat(-1)), np.int64, len(flat))
        unknown = np.flatnonzero(found < 0)
        missing = [flat[i] for i in unknown.tolist()]
        new = list(dict.fromkeys(missing))
        self._add(new, *self.pieces.best_columns(new), np.zeros(len(new), np.int64))
        found[unknown] = [self[s] for s in missing]
        self.uses += np.bincount(found, minlength=len(self))
        return found, at

    def alternatives(self, number: int, n: int) -> list[tuple[float, bytes, bytes]]:
        """(loss to the best, ids as little-endian 32-bit integers, what they spell) of other segmentations, best first."""
        stretch = self.names[number]
        if (stretch, n) not in self.lists:
            if self.listed > CACHE_BYTES // 4:
                self.lists.clear()
                self.listed = 0
            chosen = tuple(self.ids[self.start[number] :][: self.count[number]].tolist())
            others = [(float(self.score[number]) - s, np.array(ids, "<i4")) for s, ids in self.pieces.n_best(stretch, n) if ids != chosen]
            found = [(loss, ids.tobytes(), self.pieces.spell(ids)[0].tobytes()) for loss, ids in others[: n - 1]]
            self.lists[stretch, n] = found
            self.listed += sum(ENTRY_BYTES + len(ids) + len(spelled) for _, ids, spelled in found)
        return self.lists[stretch, n]

    def n_best(self, numbers: np.ndarray, losses: np.ndarray, n: int) -> list[tuple[float, dict[int, tuple[bytes, bytes]]]]:
        """The ``n`` best of a text: (loss to the best, {stretch: other ids and what they spell}), best first.

        A segmentation among the n best departs from the best one only in stretches whose own
        second best is among the n - 1 smallest losses: otherwise that many better ones exist.
        ``losses`` are those of the stretches; they are used up.
        """
        ways: list[tuple[float, dict[int, tuple[bytes, bytes]]]] = [(0.0, {})]
        for _ in range(min(n - 1, len(losses))):
            i = int(losses.argmin())
            if losses[i] == np.inf:
                break
            losses[i] = np.inf
            others = self.alternatives(int(numbers[i]), n)
            ways = sorted(
                [*ways, *[(loss + more, {**way, i: other}) for loss, way in ways for more, *other in others]], key=lambda x: (x[0], len(x[1]))
            )[:n]
        return ways


_SEGMENTERS: dict[str, Segmenter] = {}


def segmenter(path: str) -> Segmenter:
    if path not in _SEGMENTERS:
        _SEGMENTERS[path] = Segmenter(path)
    return _SEGMENTERS[path]


def _segmented(batches: Iterator[pa.RecordBatch], path: str, n: int, with_ids: bool) -> Iterator[pa.RecordBatch]:
    own = segmenter(path)
    for batch in batches:
        for at in range(0, batch.num_rows, TEXTS):
            part = batch.slice(at, TEXTS)
            texts = [x or "" for x in part.column(1).to_pylist()]
            numbers, places = own.numbers(texts)
            step = TOLD_TEXTS if with_ids else TEXTS
            for low in range(0, len(texts), step):
                some = places[low : low + step + 1]
                yield _batch(own, part.column(0).slice(low, step), texts[low : low + step], numbers[some[0] : some[-1]], some - some[0], n, with_ids)


def _batch(
    own: Segmenter, doc_ids: pa.Array, texts: list[str], numbers: np.ndarray, places: np.ndarray, n: int, with_ids: bool
) -> pa.RecordBatch:
    """``numbers`` are those of the texts' stretches, ``places`` where those of each text begin."""
    columns: list[list] = [[] for _ in range(6)]
    told = _Told()
    count, score, loss = own.count[numbers], own.score[numbers], own.loss[numbers]
    ids, id_at = _spans(own.ids, own.start[numbers], count), np.concatenate([[0], np.cumsum(count)])
    spelled, at = own.pieces.spell(ids)
    id_at, byte_at = (4 * id_at).tolist(), at[id_at].tolist()
    raw, spelled = ids.tobytes(), spelled.tobytes()
    for t, text in enumerate(texts):
        low, high = int(places[t]), int(places[t + 1])
        own_raw, own_spelled = raw[id_at[low] : id_at[high]], spelled[byte_at[low] + 1 : byte_at[high]]
        best = float(sum(score[low:high].tolist()))
        ways = own.n_best(numbers[low:high], loss[low:high], n)
        row = (len(own_raw) // 4, zlib.crc32(own_raw), best, [best - x for x, _ in ways], zlib.crc32(own_spelled), own_spelled == text.encode())
        for column, value in zip(columns, row, strict=True):
            column.append(value)
        if with_ids:
            told.ways.append(len(ways))
            for _, way in ways:
                other = {low + i: x for i, x in way.items()}
                told.raw.append(_changed(raw, id_at, low, high, {i: x for i, (x, _) in other.items()}) if way else own_raw)
                told.decoded.append(_changed(spelled, byte_at, low, high, {i: x for i, (_, x) in other.items()})[1:] if way else own_spelled)
    arrays = [doc_ids, pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.float64()),
              pa.array(columns[3], pa.list_(pa.float64())), pa.array(columns[4], pa.int64()), pa.array(columns[5], pa.bool_())]
    names = ["doc_id", "n_pieces", "ids_crc32", "score", "scores", "decoded_crc32", "round_trip"]
    if with_ids:
        arrays += told.arrays()
        names += ["segmentations", "decoded"]
    return pa.RecordBatch.from_arrays(arrays, names)


def _changed(whole: bytes, at: list[int], low: int, high: int, other: dict[int, bytes]) -> bytes:
    """Stretches ``low`` to ``high`` of ``whole``, some of them others; ``at`` is where each begins."""
    parts, done = [], low
    for i in sorted(other):
        parts += [whole[at[done] : at[i]], other[i]]
        done = i + 1
    return b"".join([*parts, whole[at[done] : at[high]]])


class _Told:
    """Ids of all segmentations of each text, and the texts decoded from them."""

    def __init__(self):
        self.raw: list[bytes] = []
        self.ways: list[int] = []
        self.decoded: list[bytes] = []

    def arrays(self) -> list[pa.Array]:
        ends = np.cumsum([0, *[len(x) // 4 for x in self.raw]])
        each = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(self.raw), "<i4")))
        of_text = pa.array(np.cumsum([0, *self.ways]), pa.int32())
        return [pa.ListArray.from_arrays(of_text, each), pa.ListArray.from_arrays(of_text, pa.array(self.decoded, pa.string()))]


def segmented(docs: DataFrame, model: str, n: int = 4, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(doc_id, n_pieces, ids_crc32, score, scores, decoded_crc32, round_trip[, segmentations, decoded]).

    For every row of ``docs`` the whole text's best segmentation (number of ids, crc32 of the ids
    as little-endian 32-bit integers, score), the scores of its ``n`` best ones (fewer if there
    are fewer), and the text decoded from the best one's ids: its crc32, and whether it equals
    the text. ``segmentations`` are the ids of the n best, ``decoded`` the text decoded from each of
    them. At equal scores those of a text come first that depart from the best one in fewer
    stretches, and inside a stretch that with the longer last piece, then the longer one before it,
    and so on. A blank is put before the text and taken off again. Null and empty texts have no pieces and one empty segmentation. Null and
    repeated ids are rows like others; other columns are ignored.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    schema = "doc_id long, n_pieces long, ids_crc32 long, score double, scores array<double>, decoded_crc32 long, round_trip boolean"
    return docs.mapInArrow(lambda it: _segmented(it, model, n, with_ids), schema + ", segmentations array<array<int>>, decoded array<string>" * with_ids)
