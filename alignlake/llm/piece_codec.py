"""SentencePiece encoding and decoding of BPE models by suffix-array matching.

A batch of texts is encoded at once. Between two characters that stand side by side in no piece of the model merging never reaches across, so a
text is cut there into stretches, mostly words and marks. The distinct stretches of a batch that are not known yet are laid end to end and

1. indexed: a suffix array over the first ``longest piece`` characters, by sorting fixed-width keys;
2. matched: every piece of the model is searched for in the suffix array by binary search, all pieces
   together, which gives its range of occurrences;
3. turned into edges (start, end, piece), sorted by the position where they end inside their stretch;
4. relaxed in that order. The last piece of a prefix's encoding is the one edge whose left neighbour, the last piece of the
   encoding up to its start, may stand beside it: two pieces are compatible if merging their characters by rank
   never joins across their border. This gives what merging pairs by rank gives, without a queue. Stretches of more than ``WINDOW`` characters are
   relaxed in overlapping windows side by side, which are put together at pieces that both windows have.

Characters that no piece covers become byte pieces. Encoding equals the library's ``encode`` for models with an identity
normalizer (no character map, no removal of extra white space) and escaped white space; others are refused. Decoding is the library's too: texts come
back exactly, but for a literal U+2581, which the format takes for a space.

Null texts have null ids and decode to null; empty texts have no ids. Repeated rows get equal ids. Other columns stay as they are; an empty
table gives an empty result. The model file's path is a parameter; the file is read on the driver, and what is built of it is sent to the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
KNOWN_STRETCHES = 300_000
PIECE = 1 << 20  # characters in work at once
MATCHED = 1 << 18  # characters of new stretches that are matched at once
WINDOW, OVERLAP = 1024, 256
LANES = 16
NORMAL, BYTE = 1, 6


class Model:
    """Pieces of a BPE model with what matching and relaxing need, as arrays."""

    def __init__(self, data: bytes):
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        proto.ParseFromString(data)
        norm = proto.normalizer_spec
        if proto.trainer_spec.model_type != 2 or norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces:
            raise ValueError("only BPE models with an identity normalizer and escaped white space are supported")
        self.prefix = bool(norm.add_dummy_prefix)
        self.names = [p.piece for p in proto.pieces]
        kinds = np.array([p.type for p in proto.pieces])
        if set(kinds.tolist()) - {1, 2, 3, 6}:
            raise ValueError("user-defined and unused pieces are not supported")
        self.bytes = np.full(256, -1, np.int64)
        for i in np.flatnonzero(kinds == BYTE):
            self.bytes[int(self.names[i][3:5], 16)] = i
        self.unknown = int(np.flatnonzero(kinds == 2)[0])
        self.control = set(np.flatnonzero(kinds == 3).tolist())
        ids = np.flatnonzero(kinds == NORMAL)
        self.by_space = not any(SPACE in self.names[i].lstrip(SPACE) for i in ids)
        self.size = len(self.names)
        score = np.array([p.score for p in proto.pieces])
        # rank: 0 is merged first; characters that stand alone are never merged and rank last
        self.rank = np.full(self.size, self.size + 1, np.int64)
        order = sorted((i for i in ids if len(self.names[i]) > 1), key=lambda i: (-score[i], i))
        self.rank[order] = np.arange(len(order))
        self.piece = {self.names[i]: int(i) for i in ids}
        self._splits(order)

    def _splits(self, order: list[int]) -> None:
        """How each piece is made, and every way to join two pieces into one."""
        left, right = np.full(self.size, -1, np.int64), np.full(self.size, -1, np.int64)
        joins = []
        self.made = np.ones(self.size, bool)
        for i in order:
            name = self.names[i]
            for k in range(1, len(name)):
                a, b = self.piece.get(name[:k]), self.piece.get(name[k:])
                if a is not None and b is not None:
                    joins.append((a * self.size + b, i))
        self.join = dict(joins)
        self._table(np.array([j[0] for j in joins], np.int64), np.array([j[1] for j in joins], np.int64))
        for i in order:
            parts = self.merged(self.names[i], but=i)
            if len(parts) == 2 and self.join.get(parts[0] * self.size + parts[1]) == i:
                left[i], right[i] = parts
            else:
                self.made[i] = False  # merging never reaches this piece
        self.left, self.right = left, right

    def __getstate__(self) -> dict:
        return self.__dict__ | {"join": {}}  # tasks look joins up in the table

    def _table(self, keys: np.ndarray, made: np.ndarray) -> None:
        """Open addressing over the joins, filled round by round, so that lookups are a few gathers."""
        size = 1 << max(4, int(2 * len(keys)).bit_length())
        self.shift = np.uint64(64 - size.bit_length() + 1)
        self.slot_key, self.slot_made = np.full(size, -1, np.int64), np.zeros(size, np.int64)
        self.probes, left = 0, np.arange(len(keys))
        while len(left):
            slot = self._slot(keys[left], self.probes)
            free = np.flatnonzero(self.slot_key[slot] < 0)
            _, first = np.unique(slot[free], return_index=True)
            taken = free[first]
            self.slot_key[slot[taken]], self.slot_made[slot[taken]] = keys[left[taken]], made[left[taken]]
            left = np.delete(left, taken)
            self.probes += 1

    def _slot(self, keys: np.ndarray, probe: int) -> np.ndarray:
        home = ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)
        return (home + probe * (probe + 1) // 2) % len(self.slot_key)

    def joined(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which pairs (left * size + right) join, and into what."""
        made, hit = np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        open_ = np.arange(len(keys))
        for probe in range(self.probes):
            slot = self._slot(keys[open_], probe)
            found = self.slot_key[slot]
            same = found == keys[open_]
            hit[open_[same]] = True
            made[open_[same]] = self.slot_made[slot[same]]
            open_ = open_[~same & (found >= 0)]
            if not len(open_):
                break
        return hit, made

    def merged(self, text: str, but: int | None = None) -> list[int]:
        """Pieces of a short text by merging the pair of best rank, leftmost first; ``but`` is never made."""
        parts = [self.piece.get(c, -1) for c in text]
        while True:
            best = None
            for k in range(len(parts) - 1):
                made = self.join.get(parts[k] * self.size + parts[k + 1]) if parts[k] >= 0 and parts[k + 1] >= 0 else None
                if made is not None and made != but and (best is None or self.rank[made] < best[0]):
                    best = (self.rank[made], k, made)
            if best is None:
                return parts
            parts[best[1] : best[1] + 2] = [best[2]]

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging by rank keeps the border between pieces a and b; a may be -1 (no left neighbour).

        The pieces are taken apart from their last merge backwards, always the one made later. Before each
        step the two parts at the border would join if that merge ranked before the later of the merges undone so far.
        Of merges of equal rank the left one comes first.
        """
        good = np.ones(len(a), bool)
        live = np.flatnonzero((a >= 0) & (a < self.size) & (b < self.size))
        x, y = a[live].copy(), b[live].copy()
        top = self.size + 1
        limit = np.full(len(live), 2 * top, np.int64)  # twice the rank, plus one if the undone merge lies to the right
        while len(live):
            hit, made = self.joined(x * self.size + y)
            when = np.where(hit, 2 * self.rank[made], 4 * top)
            # a join at the border lies left of merges inside y and right of merges inside x
            clash = hit & (when < limit)
            good[live[clash]] = False
            rx, ry = self.rank[x], self.rank[y]
            open_x, open_y = self.left[x] >= 0, self.left[y] >= 0
            go = ~clash & (open_x | open_y)
            # undo the later merge: the higher rank; of equal ranks the right one
            undo_y = open_y & (~open_x | (ry >= rx))
            limit = np.where(undo_y, 2 * ry + 1, 2 * rx)
            x, y = np.where(undo_y, x, self.right[x]), np.where(undo_y, self.left[y], y)
            live, x, y, limit = live[go], x[go], y[go], limit[go]
        return good


class Matcher:
    """Encodes batches of stretches with one model."""

    def __init__(self, model: Model):
        self.model = model
        self.longest = max((len(p) for p in model.piece), default=1)
        pieces = [i for i in model.piece.values() if model.made[i]]
        alphabet = sorted({c for i in pieces for c in model.names[i]})
        self.code = np.zeros(0x110000, np.uint16)
        self.code[[ord(c) for c in alphabet]] = np.arange(1, len(alphabet) + 1)  # 0: in no piece, and past the end
        self.words = -(-self.longest // 4)
        coded = np.zeros((len(pieces), 4 * self.words), np.uint16)
        for row, i in zip(coded, pieces, strict=True):
            row[: len(model.names[i])] = self.code[[ord(c) for c in model.names[i]]]
        self.ids = np.array(pieces, np.int64)
        self.lengths = np.array([len(model.names[i]) for i in pieces], np.int64)
        self.low = self._keys(coded)
        filled = coded.copy()
        filled[np.arange(coded.shape[1])[None, :] >= self.lengths[:, None]] = 0xFFFF
        self.high = self._keys(filled)
        self.width = np.ones(model.size, np.int64)
        self.width[self.ids] = self.lengths
        # characters that stand side by side in some piece; between all others no merge ever reaches
        self.alphabet = len(alphabet) + 1
        side = np.zeros(self.alphabet * self.alphabet, bool)
        for name in model.piece:
            codes = self.code[[ord(c) for c in name]].astype(np.int64)
            side[codes[:-1] * self.alphabet + codes[1:]] = True
        side.reshape(self.alphabet, self.alphabet)[0, :] = side.reshape(self.alphabet, self.alphabet)[:, 0] = False
        self.side = np.packbits(side)

    def beside(self, codes: np.ndarray) -> np.ndarray:
        """Whether each character may be joined with the one behind it."""
        at = codes[:-1].astype(np.int64) * self.alphabet + codes[1:]
        return (self.side[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 > 0

    def _keys(self, coded: np.ndarray) -> list[np.ndarray]:
        four = coded.astype(np.uint64).reshape(len(coded), self.words, 4)
        return [(four[:, k, 0] << np.uint64(48)) | (four[:, k, 1] << np.uint64(32)) | (four[:, k, 2] << np.uint64(16)) | four[:, k, 3]
                for k in range(self.words)]

    def _search(self, suffixes: list[np.ndarray], keys: list[np.ndarray], after: bool) -> np.ndarray:
        """Where each key would go in the sorted suffixes, before or after equal ones: one binary search for all."""
        low, high = np.zeros(len(keys[0]), np.int64), np.full(len(keys[0]), len(suffixes[0]), np.int64)
        while (low < high).any():
            mid = np.minimum((low + high) // 2, len(suffixes[0]) - 1)
            less, same = np.zeros(len(mid), bool), np.ones(len(mid), bool)
            for s, k in zip(suffixes, keys, strict=True):
                less |= same & (s[mid] < k)
                same &= s[mid] == k
            less |= same & after
            go = low < high
            low, high = np.where(go & less, mid + 1, low), np.where(go & ~less, mid, high)
        return low

    def edges(self, text: str, owner: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, length, piece) of every occurrence of every piece that stays inside a stretch."""
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        coded = np.zeros(len(points) + 4 * self.words, np.uint16)
        coded[: len(points)] = self.code[points]
        windows = np.lib.stride_tricks.sliding_window_view(coded, 4 * self.words)[: len(points)]
        keys = self._keys(windows)
        order = np.lexsort(keys[::-1])
        suffixes = [k[order] for k in keys]
        first, last = self._search(suffixes, self.low, False), self._search(suffixes, self.high, True)
        n = last - first
        piece = np.repeat(np.arange(len(n)), n)
        start = order[np.repeat(first - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum())]
        inside = start + self.lengths[piece] <= ends[owner[start]]
        return start[inside], self.lengths[piece][inside], self.ids[piece][inside]

    def encode(self, stretches: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all stretches end to end, and how many each has."""
        # long stretches are cut into windows that overlap, all relaxed side by side
        windows, at = [], []
        for i, s in enumerate(stretches):
            first = len(windows)
            if len(s) <= WINDOW:
                windows.append(s)
            else:
                windows += [s[k : k + WINDOW] for k in range(0, len(s) - OVERLAP, WINDOW - OVERLAP)]
            at.append((first, len(windows)))
        found, owner, text = self._pieces(windows)
        if len(windows) > len(stretches):
            found, owner, text = self._stitched(stretches, windows, at, found, owner, text)
        return self._spelled(found, owner, text, len(stretches))

    def _stitched(self, stretches: list[str], windows: list[str], at: list[tuple[int, int]], found: np.ndarray, owner: np.ndarray,
                  text: str) -> tuple[np.ndarray, np.ndarray, str]:
        """Windows put together again.

        Pieces stand in a text's encoding exactly if every two neighbours are compatible. Where two windows share a piece at one place,
        the pieces of the first up to it and of the second from it on are the encoding of both. A stretch with windows that share none, as in long repetitions, is relaxed place by place.
        """
        begin = np.searchsorted(owner, np.arange(len(windows) + 1))
        parts, owners = [], []
        for i, (low, high) in enumerate(at):
            pieces = found[begin[low] : begin[low + 1]]
            if high - low > 1:
                ends = np.cumsum(self._widths(pieces))
                for k in range(low + 1, high):
                    other = found[begin[k] : begin[k + 1]]
                    other_ends = (k - low) * (WINDOW - OVERLAP) + np.cumsum(self._widths(other))
                    # one piece ends where the other does, and both are as long
                    _, x, y = np.intersect1d(ends, other_ends, return_indices=True)
                    same = np.flatnonzero(self._widths(pieces[x]) == self._widths(other[y]))
                    if not len(same):
                        pieces, more = self._by_position(stretches[i], len(text))
                        text += more
                        break
                    x, y = x[same[0]], y[same[0]]
                    pieces, ends = np.concatenate([pieces[: x + 1], other[y + 1 :]]), np.concatenate([ends[: x + 1], other_ends[y + 1 :]])
            parts.append(pieces)
            owners.append(np.full(len(pieces), i))
        return np.concatenate(parts), np.concatenate(owners), text

    def _by_position(self, stretch: str, offset: int) -> tuple[np.ndarray, str]:
        """The pieces of one stretch, relaxed edge by edge; answers about two neighbours are kept. Characters in no piece are numbered from ``offset``."""
        m, n = self.model, len(stretch)
        start, length, piece = self.edges(stretch, np.zeros(n, np.int64), np.array([n]))
        alone = np.setdiff1d(np.arange(n), start[length == 1])
        start, length = np.concatenate([start, alone]), np.concatenate([length, np.ones(len(alone), np.int64)])
        piece = np.concatenate([piece, m.size + offset + alone])
        order = np.argsort(start + length, kind="stable")
        last, known = [-2] * (n + 1), {}
        last[0] = -1
        for s, e, p in zip(start[order].tolist(), (start + length)[order].tolist(), piece[order].tolist(), strict=True):
            before = last[s]
            if before == -2 or last[e] != -2:
                continue
            if before == -1 or before >= m.size or p >= m.size:
                last[e] = p
                continue
            key = (before, p)
            if key not in known:
                known[key] = bool(m.compatible(np.array([before]), np.array([p]))[0])
            if known[key]:
                last[e] = p
        pieces, at = [], n
        while at:
            pieces.append(last[at])
            at -= int(self.width[last[at]]) if last[at] < m.size else 1
        return np.array(pieces[::-1], np.int64), stretch

    def _widths(self, pieces: np.ndarray) -> np.ndarray:
        return np.where(pieces < self.model.size, self.width[np.minimum(pieces, self.model.size - 1)], 1)

    def _pieces(self, stretches: list[str]) -> tuple[np.ndarray, np.ndarray, str]:
        """(pieces, owner, text): the pieces of all stretches, the stretch of each, and all texts; a character ``k`` in no piece is ``size + k``."""
        m, text = self.model, "".join(stretches)
        sizes = np.array([len(s) for s in stretches], np.int64)
        starts = np.append(0, np.cumsum(sizes)[:-1])
        owner = np.repeat(np.arange(len(stretches)), sizes)
        start, length, piece = self.edges(text, owner, starts + sizes)
        # a character in no piece is an edge of its own, numbered beyond the pieces
        covered = np.zeros(len(text), bool)
        covered[start[length == 1]] = True
        alone = np.flatnonzero(~covered)
        start, length = np.concatenate([start, alone]), np.concatenate([length, np.ones(len(alone), np.int64)])
        piece = np.concatenate([piece, m.size + alone])
        rank = start + length - starts[owner[start]]
        order = np.argsort(rank, kind="stable")
        start, length, piece, rank = start[order], length[order], piece[order], rank[order]
        last = np.full(len(text) + len(stretches) + 1, -2, np.int64)  # one cell per border; a stretch's first border is before its text
        source = start + owner[start]
        target = source + length
        last[starts + np.arange(len(starts))] = -1
        borders = np.append(0, np.flatnonzero(np.diff(rank)) + 1).tolist()
        for low, high in zip(borders, [*borders[1:], len(rank)], strict=True):
            before = last[source[low:high]]
            reached = np.flatnonzero(before != -2)
            good = reached[m.compatible(before[reached], piece[low:high][reached])]
            last[target[low:high][good]] = piece[low:high][good]
        return *self._walk_back(sizes, starts, last), text

    def _walk_back(self, sizes: np.ndarray, starts: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        floor = starts + np.arange(len(starts))
        at = floor + sizes
        steps, owners = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        live = np.flatnonzero(at > floor)
        while len(live):
            found = last[at[live]]
            steps.append(found)
            owners.append(live)
            at[live] -= self._widths(found)
            live = live[at[live] > floor[live]]
        found, owner = np.concatenate(steps[::-1]), np.concatenate(owners[::-1])
        order = np.argsort(owner, kind="stable")
        return found[order], owner[order]

    def _spelled(self, found: np.ndarray, owner: np.ndarray, text: str, count: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids, with the bytes of characters in no piece, and the number of ids of each stretch."""
        m = self.model
        strange = np.flatnonzero(found >= m.size)
        if len(strange):
            spelled = [m.bytes[np.frombuffer(text[k].encode("utf-8", "surrogatepass"), np.uint8)] for k in (found[strange] - m.size).tolist()]
            spelled = [x if x.min() >= 0 else np.array([m.unknown]) for x in spelled]
            times = np.ones(len(found), np.int64)
            times[strange] = [len(x) for x in spelled]
            is_strange = np.repeat(found >= m.size, times)
            found, owner = np.repeat(found, times), np.repeat(owner, times)
            found[is_strange] = np.concatenate(spelled)
        return found, np.bincount(owner, minlength=count)


class Codec:
    """Encodes and decodes texts; encodings of stretches are kept between batches, end to end in one array."""

    def __init__(self, model: Model):
        self.model, self.matcher = model, Matcher(model)
        own = [b"" if i in model.control else n.replace(SPACE, " ").encode() for i, n in enumerate(model.names)]
        for value, i in enumerate(model.bytes.tolist()):
            if i >= 0:
                own[i] = bytes([value])
        own[model.unknown] = " ⁇ ".encode()
        self.spelled = own
        # by the two hashes of a stretch, in order of the first: where its ids are in ``flat``, how many, and the last batch that had it
        self.known = np.empty((0, 2), np.uint64)
        self.begin, self.size, self.used = (np.empty(0, np.int64) for _ in range(3))
        self.flat, self.batch = np.empty(0, np.int64), 0

    def _stretches(self, texts: list[str]) -> tuple[str, np.ndarray, np.ndarray, np.ndarray]:
        """(whole, starts, sizes, counts): all texts as one, cut where no piece reaches across, and the stretches of each text."""
        m = self.matcher
        marked = [t.replace(" ", SPACE) for t in texts]
        if self.model.prefix:
            marked = [SPACE + t if t else t for t in marked]
        whole = "".join(marked)
        lengths = np.array([len(t) for t in marked], np.int64)
        points = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = m.code[points]
        cut = np.ones(len(points), bool)
        cut[1:] = ~m.beside(codes) if len(codes) else cut[1:]
        firsts = np.cumsum(lengths) - lengths
        cut[firsts[lengths > 0]] = True
        starts = np.flatnonzero(cut)
        self._points, self._codes = points, codes
        return whole, starts, np.diff(np.append(starts, len(points))), np.diff(np.append(np.searchsorted(starts, firsts), len(starts)))

    def _hashes(self, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Two 64-bit hashes per stretch, of its characters and their number."""
        import xxhash

        lanes = np.append(self._codes, np.zeros(LANES, np.uint16))[starts[:, None] + np.arange(LANES)]
        lanes[np.arange(LANES) >= sizes[:, None]] = 0
        lanes = lanes.view(np.uint64).copy()
        strange = self._codes[starts] == 0
        lanes[strange, 0] = self._points[starts[strange]]
        lanes[strange, 1] = 1
        raw = self._points.tobytes()
        for i in np.flatnonzero(sizes > LANES):
            lanes[i, :2] = np.frombuffer(xxhash.xxh3_128_digest(raw[4 * starts[i] : 4 * (starts[i] + sizes[i])]), np.uint64)
            lanes[i, 2:] = 0
        out = np.empty((len(starts), 2), np.uint64)
        for k, factor in enumerate((0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)):
            h = sizes.astype(np.uint64)
            for lane in lanes.T:
                h = (h ^ lane) * np.uint64(factor)
                h ^= h >> np.uint64(29)
                h *= np.uint64(0x94D049BB133111EB)
                h ^= h >> np.uint64(32)
            out[:, k] = h
        return out

    def _places(self, hashes: np.ndarray) -> np.ndarray:
        """The row of each stretch among the known ones, -1 for new ones."""
        at = np.searchsorted(self.known[:, 0], hashes[:, 0])
        inside = at < len(self.known)
        at = np.where(inside, at, 0)
        return np.where(inside & (self.known[at] == hashes).all(1), at, -1) if len(self.known) else np.full(len(hashes), -1)

    def _learn(self, hashes: np.ndarray, stretches: list[str]) -> None:
        low, held = 0, 0
        ids, counts = [], []
        for i, s in enumerate(stretches):
            held += len(s)
            if held >= MATCHED or i + 1 == len(stretches):
                found, sizes = self.matcher.encode(stretches[low : i + 1])
                ids.append(found)
                counts.append(sizes)
                low, held = i + 1, 0
        size = np.concatenate(counts)
        known, sizes = np.concatenate([self.known, hashes]), np.concatenate([self.size, size])
        begin = np.concatenate([self.begin, len(self.flat) + np.cumsum(size) - size])
        used = np.concatenate([self.used, np.full(len(size), self.batch)])
        order = np.argsort(known[:, 0], kind="stable")
        self.known, self.size, self.begin, self.used = known[order], sizes[order], begin[order], used[order]
        self.flat = np.concatenate([self.flat, *ids])

    def _forget(self) -> None:
        """Keep what the last batch used."""
        kept = self.used == self.batch
        size, begin = self.size[kept], self.begin[kept]
        ends = np.cumsum(size)
        self.flat = self.flat[np.repeat(begin - ends + size, size) + np.arange(int(ends[-1]) if len(ends) else 0)]
        self.known, self.size, self.begin, self.used = self.known[kept], size, ends - size, self.used[kept]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text. What is kept from earlier batches only saves time."""
        whole, starts, sizes, counts = self._stretches(texts)
        if not len(starts):
            return [np.empty(0, np.int64) for _ in texts]
        if len(self.known) > KNOWN_STRETCHES:
            self._forget()
        self.batch += 1
        hashes = self._hashes(starts, sizes)
        first_hash, one, place = np.unique(hashes[:, 0], return_index=True, return_inverse=True)
        if (hashes[one][place] != hashes).any():  # the first hashes of two stretches are equal: take both
            _, one, place = np.unique(hashes.view("V16").ravel(), return_index=True, return_inverse=True)
        distinct = hashes[one]
        fresh = np.flatnonzero(self._places(distinct) < 0)
        if len(fresh):
            self._learn(distinct[fresh], [whole[i : i + n] for i, n in zip(starts[one[fresh]].tolist(), sizes[one[fresh]].tolist(), strict=True)])
        rows = self._places(distinct)
        self.used[rows] = self.batch
        at = rows[place.ravel()]
        number = self.size[at]
        ends = np.cumsum(number)
        ids = self.flat[np.repeat(self.begin[at] - ends + number, number) + np.arange(int(ends[-1]))]
        borders = np.append(0, ends)[np.append(0, np.cumsum(counts))]
        return [ids[i:j] for i, j in zip(borders[:-1], borders[1:], strict=True)]

    def decode(self, ids: np.ndarray) -> str:
        """The text of a sequence of ids."""
        m = self.model
        text = b"".join(map(self.spelled.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return text[1:] if m.prefix and text.startswith(" ") else text


def with_pieces(docs: DataFrame, model_file: str, text_column: str = "text", ids: str = "piece_ids", decoded: str = "decoded") -> DataFrame:
    """``docs`` with the ids of each text and the text decoded from them."""
    with open(model_file, "rb") as f:
        data = f.read()
    codec = Codec(Model(data))
    kept = [f for f in docs.schema.fields if f.name not in (ids, decoded)]
    at = [f.name for f in kept].index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, size = 0, 0
            lengths = [len(t or "") for t in batch.column(at).to_pylist()]
            for i, n in enumerate(lengths):
                size += n
                if size < PIECE and i + 1 < len(lengths):
                    continue
                part = batch.slice(first, i + 1 - first)
                texts = part.column(at).to_pylist()
                found = codec.encode([t or "" for t in texts])
                rows = [None if t is None else x.astype(np.int32) for t, x in zip(texts, found, strict=True)]
                back = [None if t is None else codec.decode(x) for t, x in zip(texts, found, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(rows, pa.list_(pa.int32())), pa.array(back, pa.string())], [*part.schema.names, ids, decoded])
                first, size = i + 1, 0

    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in kept], f"`{ids}` array<int>", f"`{decoded}` string"])
    return docs.select(*[F.col(f"`{f.name}`") for f in kept]).mapInArrow(run, schema)
