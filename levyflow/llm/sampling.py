"""Distinct sampled segmentations of a text, by Gumbel top-k over the lattice of its pieces.

The probability of a segmentation is proportional to the product of its pieces' weights. The search
keeps a heap of disjoint sets of segmentations, each with the perturbed log-probability of its best
member: a Gumbel variable at the set's log-probability, cut off at the value of the set it came from.
Popping a set emits its best member, drawn by walking the lattice, and splits the rest into sets that
agree with it up to some word and differ there. As the values are exact, the search goes straight to the
members that are emitted, and these are a sample without replacement. Pieces never cross the end of a
word, so lattices are built once for each distinct word, and all words of many texts walk together; the
sets of many texts are valued together, too.
"""

from __future__ import annotations

import heapq
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from levyflow.llm.shared import ship_package

MODEL = "piece_bpe_32k.model"
SAMPLES = 2
# Words whose lattices a Python worker remembers, about 600 bytes each.
KNOWN_WORDS = 400_000
# Texts walk together up to this many characters; a longer text walks alone.
GROUP_CHARS = 2_000_000
SPACE = "▁"
# Odd constants of the counter-based generator (splitmix64).
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_STEP = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03), np.uint64(0x8CB92BA72F3D8DD7))
# Words that are looked at first for where to branch, and what a draw of 54 bits can add at most.
_NEAR, _ABOVE = 256, 38.0
# Texts whose sets are valued together.
_ROWS = 256
_LOW = (1 << 64) - 1


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path(MODEL)


class Vocabulary:
    """Pieces with log-weights by Zipf's law on their rank, and bytes for characters without a piece.

    A BPE vocabulary has merge ranks instead of probabilities; the weight of rank r is 1 / (r + 1).
    """

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.bytes: list[bytes] = [b""] * size
        self.byte_ids = [0] * 256
        self.ids: dict[str, int] = {}
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)], self.bytes[i] = i, bytes([int(piece[3:5], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.ids[piece], self.bytes[i] = i, piece.encode()
        first = min(self.ids.values())
        self.weights = np.zeros(size)
        for i in self.ids.values():
            self.weights[i] = -math.log(i - first + 2)
        self.byte_weight = -math.log(size)
        self.spellings = pa.array(self.bytes, pa.large_binary())
        self._grow_tree()
        # Kinds of characters: 0 the blank, 1 those that words are made of, 2 the rest.
        self.kinds = np.full(0x110000, 2, dtype=np.uint8)
        self.kinds[ord(SPACE)] = 0
        self.kinds[[ord(c) for c in _letters(self.ids)]] = 1
        self.lattices = Lattices(self)

    def _grow_tree(self) -> None:
        """The tree of all beginnings of pieces: node ``i`` is reached by ``branch[i]``, which is the parent's
        number and a character; ``piece[i]`` is the id of the piece that ends there, or -1."""
        beginnings = sorted({p[:n] for p in self.ids for n in range(1, len(p) + 1)}, key=len)
        number = {"": 0} | {p: i for i, p in enumerate(beginnings, 1)}
        branch = np.array([number[p[:-1]] << 21 | ord(p[-1]) for p in beginnings], dtype=np.int64)
        order = np.argsort(branch)
        # Nodes are numbered by their place in the sorted branches, from 1; the root is 0.
        renamed = np.zeros(len(beginnings) + 1, dtype=np.int64)
        renamed[order + 1] = np.arange(1, len(order) + 1)
        parents = renamed[branch >> 21]
        again = np.argsort(parents << 21 | branch & 0x1FFFFF)
        while not np.array_equal(again, order):  # a child's place depends on its parent's: settle level by level
            order = again
            renamed[order + 1] = np.arange(1, len(order) + 1)
            parents = renamed[branch >> 21]
            again = np.argsort(parents << 21 | branch & 0x1FFFFF)
        self.branch = (parents << 21 | branch & 0x1FFFFF)[order]
        self.piece = np.array([self.ids.get(p, -1) for p in beginnings], dtype=np.int64)[order]

    def cut(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The code points of all texts on end, where the words begin in them, and each text's number of words.
        Cuts are where no piece can lie across: before blanks, and between the characters that pieces have in
        common with the letter a, directly or through others, and the rest."""
        bodies = [SPACE + t if t else "" for t in texts]
        code = np.frombuffer("".join(bodies).encode("utf-32-le", "surrogatepass"), dtype="<u4").copy()
        code[code == 0x20] = ord(SPACE)
        kind = self.kinds[code]
        bounds = np.concatenate([[0], np.cumsum([len(b) for b in bodies], dtype=np.int64)])
        begins = np.zeros(len(code) + 1, dtype=bool)
        begins[1:-1] = (kind[1:] != kind[:-1]) & (kind[:-1] != 0)
        begins[bounds] = True
        starts = np.flatnonzero(begins[:-1])
        return code, starts, np.diff(np.searchsorted(starts, bounds))

    def edges(self, words: list[bytes]) -> tuple[np.ndarray, ...]:
        """``word, start, length, id`` of every piece in every word, which is given in UTF-32; a character
        without a piece of its own is an edge with its negative code point, to be spelt in bytes."""
        sizes = np.array([len(w) >> 2 for w in words], dtype=np.int64)
        code = np.frombuffer(b"".join(words), dtype="<u4").astype(np.int64)
        ends = np.repeat(np.cumsum(sizes), sizes)
        place, node, found, length = np.arange(len(code)), np.zeros(len(code), dtype=np.int64), [], 0
        while len(place):
            wanted = node << 21 | code[place + length]
            at = np.minimum(np.searchsorted(self.branch, wanted), len(self.branch) - 1)
            inside = self.branch[at] == wanted
            length += 1
            ids = np.where(inside, self.piece[at], -1)
            if length == 1:
                ids = np.where(ids >= 0, ids, -code - 1)
                found.append((place, length, ids))
            else:
                found.append((place[ids >= 0], length, ids[ids >= 0]))
            on = inside & (place + length < ends[place])
            place, node = place[on], at[on] + 1
        start = np.concatenate([f[0] for f in found])
        word = np.repeat(np.arange(len(words)), sizes)[start]
        before = np.cumsum(sizes) - sizes
        lengths = np.repeat([f[1] for f in found], [len(f[0]) for f in found])
        return word, start - before[word], lengths, np.concatenate([f[2] for f in found])

    def weigh(self, ids: np.ndarray) -> np.ndarray:
        return np.where(ids >= 0, self.weights[np.maximum(ids, 0)], _spelling(ids) * self.byte_weight)

    def spelt(self, ids: np.ndarray) -> np.ndarray:
        """Ids with the characters that have no piece replaced by their bytes."""
        return self.spelt_runs(ids, np.array([len(ids)]))[0]

    def spelt_runs(self, ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for runs of ids on end, with the runs' new sizes."""
        without = np.flatnonzero(ids < 0)
        if not len(without):
            return ids, sizes
        point = -ids[without].astype(np.int64) - 1
        more = np.ones(len(ids), dtype=np.int64)
        more[without] = count = _spelling(ids[without])
        ends = np.concatenate([[0], np.cumsum(more)])
        out, byte_ids = np.repeat(ids, more), np.array(self.byte_ids, dtype=ids.dtype)
        for n, lead in ((1, 0), (2, 0xC0), (3, 0xE0), (4, 0xF0)):
            own, at = point[count == n], ends[without[count == n]]
            for i in range(n):
                byte = own >> 6 * (n - 1 - i)
                out[at + i] = byte_ids[byte & 0x3F | 0x80 if i else byte | lead]
        return out, np.diff(ends[np.concatenate([[0], np.cumsum(sizes)])])

    def spelling(self, runs: list[np.ndarray]) -> list[bytes]:
        """The bytes of each run of ids, with the blanks as the model has them."""
        if not runs:
            return []
        return _binaries(self.spellings.take(pa.array(np.concatenate(runs))), np.cumsum([0] + [len(r) for r in runs]))

    def decode(self, ids) -> str:
        table = self.bytes
        text = b"".join([table[i] for i in ids]).decode("utf-8", "surrogatepass")
        return text.replace(SPACE, " ")[1:]


def _letters(pieces) -> list[str]:
    """The characters that pieces have in common with the letter a, directly or through others."""
    joined: dict[str, str] = {}

    def root(c: str) -> str:
        while joined.setdefault(c, c) != c:
            joined[c] = c = joined[joined[c]]
        return c

    for piece in pieces:
        own = piece.lstrip(SPACE)
        for c in own[1:]:
            joined[root(c)] = root(own[0])
    return [c for c in sorted(joined) if root(c) == root("a")]


def _binaries(array: pa.LargeBinaryArray, cuts: np.ndarray | None = None) -> list[bytes]:
    """The values of an array without nulls, or those between two cuts on end."""
    if not len(array):
        return [] if cuts is None else [b""] * (len(cuts) - 1)
    _, offsets, data = array.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64)[array.offset : array.offset + len(array) + 1]
    ends, data = (ends if cuts is None else ends[cuts]).tolist(), data.to_pybytes() if data else b""
    return [data[low:high] for low, high in zip(ends, ends[1:])]


def _spelling(ids: np.ndarray) -> np.ndarray:
    """Bytes of the characters that negative ids stand for."""
    point = -ids - 1
    return 1 + (point > 0x7F) + (point > 0x7FF) + (point > 0xFFFF)


@cache
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class Lattices:
    """The lattices of all words met so far, with each edge's probability among those at its place.

    The draws from a place, 32 bits, are dealt to its edges in proportion; ``upto`` is an edge's last one
    (an edge without any has the last one of the edge before).
    """

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.forget()

    def forget(self) -> None:
        # Words are known by their UTF-32.
        self.number: dict[bytes, int] = {}
        whole = np.zeros(0, dtype=np.int64)
        self.starts, self.upto, self.offsets = whole, whole.astype(np.uint32), np.zeros(1, dtype=np.int64)
        # An edge that ends its word has target -1.
        self.target, self.ids = whole.astype(np.int32), whole.astype(np.int32)
        self.logp, self.ways = np.zeros(0), np.zeros(0)
        # The arrays have room for more: entries in use.
        self.places, self.edges = 0, 0

    def numbers(self, code: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The numbers of the words that begin at ``starts``; words that are new get one and a lattice."""
        if not len(starts):
            return np.zeros(0, dtype=np.int64)
        ends = np.append(starts, len(code)) * 4
        every = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(code)]).dictionary_encode()
        words = _binaries(every.dictionary)
        found = [*map(self.number.get, words)]
        new = [w for w, n in zip(words, found) if n is None]
        if new:
            self._add(sorted(new, key=len, reverse=True))
            found = [self.number[w] if n is None else n for w, n in zip(words, found)]
        return np.array(found, dtype=np.int64)[every.indices.to_numpy()]

    def _put(self, name: str, used: int, more: np.ndarray) -> None:
        """Write behind the entries in use, in an array of twice the size if there is no room."""
        own = getattr(self, name)
        if used + len(more) > len(own):
            own = np.empty(max(2 * used, used + len(more)), dtype=own.dtype)
            own[:used] = getattr(self, name)[:used]
            setattr(self, name, own)
        own[used : used + len(more)] = more

    def _add(self, words: list[bytes]) -> None:
        """Lattices of new words, the longest first. Among the new places, ``first[t] + word`` is ``t``
        characters before a word's end, so that places of one distance are summed together."""
        sizes = np.array([len(w) >> 2 for w in words], dtype=np.int64)
        alive = np.searchsorted(-sizes, -np.arange(1, sizes[0] + 1), side="right")
        first = np.concatenate([[0, 0], np.cumsum(alive)])
        word, start, length, ids = self.vocab.edges(words)
        left = sizes[word] - start
        after = left - length
        place = first[left] + word
        order = np.argsort(place, kind="stable")
        target = np.where(after > 0, first[after] + word, -1)[order]
        ids, word_of = ids[order], first[sizes] + np.arange(len(words))
        offsets = np.searchsorted(place[order], np.arange(first[-1] + 1))
        logp, share, ways = _sums(self.vocab.weigh(ids), target, offsets, first)

        upto = np.round(share * 2.0**32).astype(np.int64) - 1
        known, places, edges = len(self.number), self.places, self.edges
        self.number.update(zip(words, range(known, known + len(words))))
        self._put("starts", known, word_of + places)
        self._put("ways", places, ways)
        self._put("offsets", places + 1, offsets[1:] + edges)
        for name, more in (("upto", np.maximum(upto, 0)), ("target", np.where(target < 0, -1, target + places)), ("ids", ids), ("logp", logp)):
            self._put(name, edges, more)
        self.places, self.edges = places + len(ways), edges + len(ids)

    def walk(self, words: np.ndarray, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Draw a segmentation of each word: log-probabilities, all edges in order, and where each word's begin."""
        at, total, sizes = self.starts[words], np.zeros(len(words)), np.zeros(len(words), dtype=np.int64)
        active, seeds_on, taken, step = np.arange(len(words)), seeds, [], 0
        while len(active):
            edge = self._pick(at, draws(seeds_on, step, _STEP[1], 32))
            taken.append((active, edge))
            total[active] += self.logp[edge]
            target = self.target[edge]
            on = np.flatnonzero(target >= 0)
            step += 1
            sizes[active] = step
            active, seeds_on, at = active[on], seeds_on[on], target[on]
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        edges = np.empty(offsets[-1], dtype=np.int64)
        for step, (who, edge) in enumerate(taken):
            edges[offsets[who] + step] = edge
        return total, edges, offsets

    def _pick(self, places: np.ndarray, drawn: np.ndarray) -> np.ndarray:
        """The edge of each place that the draw falls to; places have few edges."""
        edge = self.offsets[places]
        short = np.flatnonzero(self.upto[edge] < drawn)
        while len(short):
            edge[short] += 1
            short = short[self.upto[edge[short]] < drawn[short]]
        return edge

    def other(self, word: int, excluded: list[tuple[int, ...]], points: Iterator[float]) -> tuple[int, ...]:
        """Draw a segmentation of the word that is none of ``excluded``, by their complement's probabilities."""
        place, path, mass = int(self.starts[word]), [], 0.0
        live = [(x, math.exp(float(self.logp[list(x)].sum()))) for x in excluded]
        while place >= 0:
            edges = range(int(self.offsets[place]), int(self.offsets[place + 1]))
            logp = self.logp[edges.start : edges.stop].tolist()
            ends = self.target[edges.start : edges.stop].tolist()
            # What is left of each edge; an edge whose paths are all excluded has nothing.
            left = []
            for e, own, end in zip(edges, logp, ends):
                inside = [p for x, p in live if len(x) > len(path) and x[len(path)] == e]
                free = (self.ways[end] if end >= 0 else 1) > len(inside) if inside else True
                left.append(max(math.exp(mass + own) - sum(inside), 1e-300) if free else 0.0)
            point, chosen = next(points) * sum(left), len(left) - 1
            for n, share in enumerate(left):
                point -= share
                if point < 0 and share:
                    chosen = n
                    break
            while not left[chosen]:
                chosen -= 1
            e = edges[chosen]
            live = [(x, p) for x, p in live if len(x) > len(path) and x[len(path)] == e]
            path.append(e)
            mass += logp[chosen]
            place = ends[chosen]
        return tuple(path)


def _sums(weight: np.ndarray, target: np.ndarray, offsets: np.ndarray, first: np.ndarray):
    """Sum over all ways to the end, place by place backwards: each edge's log-probability at its place,
    its share of the place's draws up to and with it, and the number of ways from each place."""
    # The last entry is the end of a word, which target -1 picks.
    rest, ways = np.zeros(first[-1] + 1), np.ones(first[-1] + 1)
    logp, share = np.zeros(len(weight)), np.zeros(len(weight))
    for t in range(1, len(first) - 1):
        places = slice(first[t], first[t + 1])
        low, high = offsets[places.start], offsets[places.stop]
        cuts, edges = offsets[places] - low, slice(low, high)
        sizes = np.diff(np.append(cuts, high - low))
        value = weight[edges] + rest[target[edges]]
        top = np.maximum.reduceat(value, cuts)
        rest[places] = top + np.log(np.add.reduceat(np.exp(value - np.repeat(top, sizes)), cuts))
        ways[places] = np.add.reduceat(ways[target[edges]], cuts)
        logp[edges] = value - np.repeat(rest[places], sizes)
        running = np.cumsum(np.exp(logp[edges]))
        part = running - np.repeat(np.concatenate([[0.0], running])[cuts], sizes)
        part[cuts + sizes - 1] = 1.0
        share[edges] = np.minimum(part, 1.0)
    return logp, share, ways[:-1]


def draws(seeds: np.ndarray, number: int | np.ndarray, step: np.uint64, bits: int) -> np.ndarray:
    """Random numbers of so many bits that depend on the seed and the number alone."""
    z = seeds + (np.uint64(number * int(step) & _LOW) if isinstance(number, int) else number.astype(np.uint64) * step)
    z ^= z >> np.uint64(30)
    z *= _MIX[0]
    z ^= z >> np.uint64(27)
    z *= _MIX[1]
    z ^= z >> np.uint64(31)
    z >>= np.uint64(64 - bits)
    return z.view(np.int64)


def uniform(seeds: np.ndarray, number, step: np.uint64) -> np.ndarray:
    """The same in (0, 1)."""
    return draws(seeds, number, step, 53) * 2.0**-53 + 2.0**-54


def _points(seed: int) -> Iterator[float]:
    """``uniform`` of one seed and the numbers from 0 with the first step, one by one."""
    step, first, second = int(_STEP[0]), int(_MIX[0]), int(_MIX[1])
    for number in range(1 << 62):
        z = seed + number * step & _LOW
        z = (z ^ z >> 30) * first & _LOW
        z = (z ^ z >> 27) * second & _LOW
        yield ((z ^ z >> 31) >> 11) * 2.0**-53 + 2.0**-54


def _seed(*parts) -> int:
    return xxhash.xxh64_intdigest(repr(parts), 42)


@dataclass
class _Leaf:
    """A segmentation: log-probabilities by word, edges in order, and where each word's edges begin."""

    logp: np.ndarray
    edges: np.ndarray
    offsets: np.ndarray
    gumbel: float

    def of(self, word: int) -> tuple[int, ...]:
        return tuple(self.edges[self.offsets[word] : self.offsets[word + 1]].tolist())


class _Search:
    """The heap of one text. An entry is ``(-value, number, leaf it came from, word, excluded there, log-probability
    of the leaf's words before)``."""

    def __init__(self, words: np.ndarray, several: np.ndarray, key):
        self.words, self.several, self.key = words, several, key
        self.leaves: list[_Leaf] = []
        self.heap: list[tuple] = []

    @property
    def bound(self) -> float:
        """The value of the best segmentation that is not emitted."""
        return -self.heap[0][0] if self.heap else -math.inf


def _split(grown: list[tuple], lattices: Lattices, wanted: int, width: int = _NEAR) -> None:
    """Put the best ``wanted`` of the sets that the rest of each new leaf's set falls into on its search's heap.

    ``grown`` has ``(search, word, excluded, log-probability before the word)``, and the leaf is its search's
    last. Sets that differ from the leaf first at one of ``width`` words from there are looked at, and at
    any later word if one of those may be among the best.
    """
    shape = (len(grown), width)
    logp, live, words = np.zeros(shape), np.zeros(shape, dtype=bool), np.array([g[1] for g in grown])
    for i, (search, word, _, _) in enumerate(grown):
        own = search.leaves[-1].logp[word : word + width]
        logp[i, : len(own)] = own
        live[i, : len(own)] = search.several[word : word + width]
    upto = logp.copy()
    upto[:, 0] += [g[3] for g in grown]
    np.cumsum(upto, axis=1, out=upto)
    before = upto - logp
    where = np.full(shape, -np.inf)
    with np.errstate(divide="ignore", over="ignore"):
        where[live] = before[live] + np.log(-np.expm1(np.minimum(logp[live], 0.0)))
        for i, (search, word, excluded, _) in enumerate(grown):
            if excluded:
                paths = [*excluded, search.leaves[-1].of(word)]
                gone = sum(math.exp(float(lattices.logp[list(x)].sum())) for x in paths)
                live[i, 0] = lattices.ways[lattices.starts[search.words[word]]] > len(paths)
                where[i, 0] = before[i, 0] + math.log(max(1 - gone, 1e-300))
        row, column = live.nonzero()
        seeds = np.array([_seed(g[0].key, len(g[0].leaves) - 1) for g in grown], dtype=np.uint64)
        gumbel = np.array([g[0].leaves[-1].gumbel for g in grown])
        chance = uniform(seeds[row], words[row] + column, _STEP[2])
        value, found = np.full(shape, -np.inf), where[live]
        value[live] = found - np.log(np.exp(found - gumbel[row]) - np.log(chance))
    best = np.argpartition(-value, wanted, axis=1)[:, :wanted] if width > wanted else np.tile(np.arange(width), (len(grown), 1))
    top = np.take_along_axis(value, best, axis=1)
    # A value is above its set's log-probability by less than _ABOVE, and those only fall.
    enough = upto[:, -1] + _ABOVE < top.min(axis=1, initial=np.inf)
    for i, (search, word, excluded, base) in enumerate(grown):
        leaf = search.leaves[-1]
        if word + width < len(leaf.logp) and not enough[i]:
            _split([grown[i]], lattices, wanted, len(leaf.logp) - word)
            continue
        for v, at in zip(top[i].tolist(), best[i].tolist()):
            if math.isfinite(v):
                out = [*(excluded if not at else []), leaf.of(word + at)]
                past = float(upto[i, at - 1]) if at else base
                heapq.heappush(search.heap, (-v, len(search.heap), len(search.leaves) - 1, word + at, out, past))


def sample_group(texts: list[str], keys: list, vocab: Vocabulary, k: int) -> list[list[tuple]]:
    """For each text up to ``k`` samples ``(ids, log-probability, value, log-inclusion)``, by falling value."""
    code, starts, counts = vocab.cut(texts)
    lattices = vocab.lattices
    if len(lattices.number) > KNOWN_WORDS:
        lattices.forget()
    words = lattices.numbers(code, starts)
    several = lattices.ways[lattices.starts[words]] > 1
    ends = np.cumsum([0, *counts]).tolist()
    searches = [_Search(words[low:high], several[low:high], key) for low, high, key in zip(ends, ends[1:], keys)]
    # The root of each text: all its segmentations, of probability one.
    values = -np.log(-np.log(uniform(np.array([_seed(s.key) for s in searches], dtype=np.uint64), 1, _STEP[0])))
    todo = [(s, value, None, 0, [], 0.0) for s, value in zip(searches, values.tolist())]
    emitted = 0
    while todo:
        for (search, value, parent, word, excluded, _), drawn in zip(todo, _suffixes(todo, lattices)):
            search.leaves.append(_joined(search, value, parent, word, excluded, drawn, lattices))
        grown = [(search, word, excluded, base) for search, _, _, word, excluded, base in todo]
        for at in range(0, len(grown), _ROWS):
            _split(grown[at : at + _ROWS], lattices, k + 1 - emitted)
        emitted += 1
        todo = []
        for s in searches:
            if len(s.leaves) < k and s.heap:
                value, _, parent, word, excluded, base = heapq.heappop(s.heap)
                todo.append((s, -value, s.leaves[parent], word, excluded, base))
    return _samples(searches, lattices, vocab)


def _suffixes(todo: list[tuple], lattices: Lattices) -> Iterator[tuple]:
    """Walk the words that each new leaf is free in: all for a root, else those after its branching word."""
    parts = [s.words if parent is None else s.words[word + 1 :] for s, _, parent, word, *_ in todo]
    ends = np.cumsum([0] + [len(p) for p in parts])
    sizes = np.diff(ends)
    seeds = np.repeat(np.array([_seed(s.key, len(s.leaves), "walk") for s, *_ in todo], dtype=np.uint64), sizes)
    within = np.arange(ends[-1]) - np.repeat(ends[:-1], sizes)
    seeds += within.astype(np.uint64) * _STEP[0]
    logp, edges, offsets = lattices.walk(np.concatenate(parts), seeds)
    bounds, ends = offsets[ends].tolist(), ends.tolist()
    for at, end, low, high in zip(ends, ends[1:], bounds, bounds[1:]):
        yield logp[at:end], edges[low:high], offsets[at : end + 1] - low


def _joined(search: _Search, value: float, parent: _Leaf | None, word: int, excluded: list, drawn: tuple, lattices: Lattices) -> _Leaf:
    logp, edges, offsets = drawn
    if parent is None:
        return _Leaf(logp, edges, offsets, value)
    points = _points(_seed(search.key, len(search.leaves), "branch"))
    path = lattices.other(int(search.words[word]), excluded, points)
    start = parent.offsets[word]
    return _Leaf(
        np.concatenate([parent.logp[:word], [lattices.logp[list(path)].sum()], logp]),
        np.concatenate([parent.edges[:start], np.array(path, dtype=np.int64), edges]),
        np.concatenate([parent.offsets[: word + 1], start + len(path) + offsets]),
        value,
    )


def _samples(searches: list[_Search], lattices: Lattices, vocab: Vocabulary) -> list[list[tuple]]:
    leaves = [leaf for s in searches for leaf in s.leaves]
    if not leaves:
        return []
    edges = np.concatenate([leaf.edges for leaf in leaves])
    ids, sizes = vocab.spelt_runs(lattices.ids[edges], np.array([len(leaf.edges) for leaf in leaves]))
    ends = np.cumsum([0, *sizes]).tolist()
    runs = (ids[low:high] for low, high in zip(ends, ends[1:]))
    found = []
    for s in searches:
        bound, own = s.bound, []
        for leaf in s.leaves:
            logp = float(leaf.logp.sum())
            # log(1 - exp(-exp(x))), which is x itself far below zero.
            x = logp - bound
            inclusion = 0.0 if x > 5 else math.log(-math.expm1(-math.exp(x))) if x > -20 else x
            own.append((next(runs), logp, leaf.gumbel, inclusion))
        found.append(own)
    return found


def sample_segmentations(
    docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = SAMPLES, model: str | None = None, ids: bool = True,
) -> DataFrame:
    """``key, rank, pieces, log_prob, gumbel, log_inclusion, ids_crc32, decoded`` of up to ``k`` distinct
    segmentations of every row's text, by falling perturbed log-probability; with ``ids``, the ids too.

    ``log_inclusion`` is the logarithm of the chance that a segmentation is in such a sample, given the
    value of the best one that is not. The draws depend on the key and the text alone, so any partitioning
    gives the same rows. ``decoded`` says whether the ids give the text back (a lower block character
    U+2581 comes back as a blank, which it is to the model).

    A text with fewer than ``k`` segmentations has them all; null and empty texts have one, of no pieces.
    Rows with a null key are sampled by the key null, rows that repeat a key each on its own. An empty
    table gives no rows. Other columns are not read.
    """
    ship_package(docs.sparkSession)
    path = model or default_model()
    names = ["key", "rank", "pieces", "log_prob", "gumbel", "log_inclusion", "ids_crc32", "decoded", "ids"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64(), pa.bool_()]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for batch in batches:
            for keys, texts in _groups(batch):
                rows, groups = [], sample_group(texts, keys, vocab, k)
                runs = [found for samples in groups for found, *_ in samples]
                backs = iter(vocab.spelling(runs))
                for name, body, samples in zip(keys, texts, groups):
                    # As the model has it: the text behind a blank, and all blanks as SPACE.
                    wanted = (SPACE + body.replace(" ", SPACE)).encode("utf-8", "surrogatepass") if body else b""
                    for rank, (found, logp, value, inclusion) in enumerate(samples, 1):
                        crc = zlib.crc32(np.ascontiguousarray(found, dtype="<u4"))
                        rows.append((name, rank, len(found), logp, value, inclusion, crc, next(backs) == wanted))
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), kinds)]
                if ids:
                    ends = np.cumsum([0] + [len(run) for run in runs])
                    columns.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(runs), pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names[: len(columns)])

    schema = ("key long, rank int, pieces long, log_prob double, gumbel double, log_inclusion double, ids_crc32 long,"
              " decoded boolean" + (", ids array<int>" if ids else ""))
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(work, schema).withColumnRenamed("key", key)


def _groups(batch: pa.RecordBatch) -> Iterator[tuple[list, list[str]]]:
    keys, texts, size = [], [], 0
    for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
        if texts and size + len(text or "") > GROUP_CHARS:
            yield keys, texts
            keys, texts, size = [], [], 0
        keys.append(key)
        texts.append(text or "")
        size += len(text or "")
    if texts:
        yield keys, texts
