"""Operator 2, SentencePiece encoding and decoding: distinct sampled segmentations of whole texts.

The vocabulary is a public SentencePiece model. Its pieces are ranked; a piece's weight follows
Zipf and Mandelbrot's law, 1 / (rank + 2.7), and a segmentation's probability is the product of
its pieces' weights over the sum for all segmentations of the text (the lattice). A character
that is no piece by itself also has its UTF-8 byte pieces, so every text can be encoded and
decoded exactly; a space is put before a text and taken off again.

``k`` segmentations are drawn without replacement by Gumbel top-k, searched best first (A*):

* Backward sums over the lattice (exact, so the heuristic is the true bound) give each edge its
  probability given the node. No piece crosses from a letter into a space, so the lattice of a
  text is a chain of small ones, one per chunk (a run of spaces and the letters after it); chunks
  are kept and shared by all texts of a worker.
* The root's perturbed score is a Gumbel draw, its best segmentation an ancestral draw. The rest
  of the space splits by the first chunk that differs; each part's best perturbed score is a
  Gumbel draw of the part's mass truncated at the parent's. The agenda holds these parts, the
  highest is taken next, drawn from, and split again.
* The score the agenda would give next is the threshold kappa; a segmentation of probability p
  is included with probability 1 - exp(-exp(log p - kappa)).

Draws are numbered hashes seeded by (doc_id, text hash), so a repeated or retried row gives
equal results. All chunks of a batch of texts move through the lattice together in numpy.

Defined cases: null text has no segmentations (an empty list), an empty text has one, without
pieces; where fewer than k exist all are returned, with inclusion one; a null doc_id seeds like
the string "null"; U+2581 in a text is encoded by bytes; repeated rows give equal results; an
empty table gives an empty result; extra columns are ignored. Texts of any length are encoded
whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollwise.llm.common import text_key

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SAMPLES = 2
#: characters encoded together, and lattice nodes kept by a worker between batches
BATCH_CHARS = 1 << 17
KEEP_NODES = 3 << 19
# How this kind of model writes a space and a byte.
SPACE = "▁"
BYTE = re.compile(r"<0x([0-9A-F]{2})>")
CHUNK = re.compile(r"[\n\t]| *[^ \n\t]+| +")
SHIFT = 2.7

_M1, _M2, _STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


class Vocabulary:
    """Pieces by id; spaces as spaces. Read once on the driver and sent to the workers (its size is the model's)."""

    def __init__(self, pieces: list[str], special: set[int]) -> None:
        self.bytes_of: list[bytes] = []
        self.piece: dict[str, int] = {}
        self.byte = [-1] * 256
        for i, p in enumerate(pieces):
            m = BYTE.fullmatch(p)
            if m:
                self.byte[int(m[1], 16)] = i
                self.bytes_of.append(bytes([int(m[1], 16)]))
            elif i in special:
                self.bytes_of.append(b"")
            else:
                text = p.replace(SPACE, " ")
                self.bytes_of.append(text.encode())
                self.piece.setdefault(text, i)
        if min(self.byte) < 0:
            raise ValueError("the model needs byte pieces to encode any text")
        if any(re.search(r"[^ ] |[\n\t]", p) for p in self.piece):
            raise ValueError("a piece crosses from a letter into a space, or holds a line break or tab")
        first = min(self.piece.values())
        self.log_weight = -np.log(np.array([i - first + SHIFT if i >= first else len(pieces) + SHIFT for i in range(len(pieces))]))
        self.log_byte_weight = -float(np.log(len(pieces) + SHIFT))
        self.longest = max(map(len, self.piece))
        self._hash_prefixes()

    def _hash_prefixes(self) -> None:
        """Open-addressed table of every prefix of a piece: two hashes, and the piece's id or -1."""
        prefixes: dict[str, int] = {}
        for p, i in self.piece.items():
            for n in range(1, len(p)):
                prefixes.setdefault(p[:n], -1)
            prefixes[p] = i
        self.bits = (4 * len(prefixes)).bit_length()
        self.key, self.check = np.zeros((2, 1 << self.bits), np.uint64)
        self.id = np.full(1 << self.bits, -1, np.int32)
        for p, i in prefixes.items():
            h = c = 0
            for x in map(ord, p):
                h, c = (h * int(_STEP) + x + 1) % 2**64, (c * int(_M2) + x + 1) % 2**64
            slot = (h * int(_M1) % 2**64) >> (64 - self.bits)
            while self.key[slot]:
                slot = (slot + 1) % (1 << self.bits)
            self.key[slot], self.check[slot], self.id[slot] = h, c, i

    def find(self, h: np.ndarray, c: np.ndarray) -> np.ndarray:
        """Slots of the prefixes with these two hashes, -1 where there is none."""
        slot = ((h * _M1) >> np.uint64(64 - self.bits)).astype(np.int64)
        out = np.full(len(h), -1)
        at = np.arange(len(h))
        while len(at):
            key = self.key[slot]
            hit = (key == h[at]) & (self.check[slot] == c[at])
            out[at[hit]] = slot[hit]
            on = ~hit & (key != 0)
            at, slot = at[on], (slot[on] + 1) % (1 << self.bits)
        return out


def load(path: str = MODEL) -> Vocabulary:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    return Vocabulary([model.id_to_piece(i) for i in ids], {i for i in ids if model.is_control(i) or model.is_unknown(i) or model.is_unused(i)})


class Numbers(dict):
    """Numbers of chunks, in the order they are first asked for; ``new`` lists those not yet in the lattices."""

    def __init__(self) -> None:
        self.new: list[str] = []

    def __missing__(self, chunk: str) -> int:
        self[chunk] = number = len(self)
        self.new.append(chunk)
        return number


class Lattices:
    """Lattices of chunks in flat arrays: nodes own runs of edges (target, unit, share of the node's mass)."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.v = vocabulary
        #: a unit is what one edge emits: a piece, or the byte pieces of a character
        self.units: list[list[int]] = [[i] for i in range(len(vocabulary.bytes_of))]
        self.unit_of_char: dict[str, int] = {}
        self.table = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.start, self.ways = np.zeros(KEEP_NODES // 8, np.int64), np.zeros(KEEP_NODES // 8)
        self.first = np.zeros(KEEP_NODES, np.int64)
        self.to, self.unit, self.upto, self.log_p = (np.zeros(2 * KEEP_NODES, t) for t in (np.int32, np.int32, float, float))
        self.clear()

    def clear(self) -> None:
        self.known = Numbers()
        self.nodes = self.edges = 0

    def _bytes(self, char: str) -> int:
        if char not in self.unit_of_char:
            self.unit_of_char[char] = len(self.units)
            self.units.append([self.v.byte[b] for b in char.encode("utf-8", "replace")])
        return self.unit_of_char[char]

    def _edges(self, text: str, code: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(node, length, unit, log weight) of every piece in the chunks, and of characters that are none."""
        v = self.v
        node = np.arange(len(code))
        h, c = np.zeros(len(code), np.uint64), np.zeros(len(code), np.uint64)
        found, single, length = [], np.zeros(len(code), bool), 0
        while len(node):
            x = code[node + length]
            h, c = h * _STEP + x, c * _M2 + x
            slot = v.find(h, c)
            length += 1
            piece = np.where(slot >= 0, v.id[slot], -1)
            hit = piece >= 0
            found.append((node[hit], np.full(hit.sum(), length), piece[hit], v.log_weight[piece[hit]]))
            if length == 1:
                single[node[hit]] = True
            on = (slot >= 0) & (node + length < end[node])
            node, h, c = node[on], h[on], c[on]
        rare = np.flatnonzero(~single)
        units = np.fromiter((self._bytes(text[i]) for i in rare.tolist()), np.int64, len(rare))
        found.append((rare, np.ones(len(rare), np.int64), units, np.full(len(rare), v.log_byte_weight)))
        found.reverse()  # rising runs of nodes, longest pieces first; a character that is no piece has no edge of length one besides
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    def add(self) -> None:
        """Lattices of the new chunks of ``known``; ``start`` has their first nodes, ``ways`` their segmentations (2^60 at most)."""
        chunks, self.known.new = self.known.new, []
        if not chunks:
            return
        v, text = self.v, "".join(chunks)
        code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
        sizes = np.fromiter(map(len, chunks), np.int64, len(chunks))
        stop = np.cumsum(sizes)
        end = np.repeat(stop, sizes)
        node, length, unit, weight = self._edges(text, code, end)
        order = np.argsort(node, kind="stable")  # by node, longest first as found
        node, length, unit, weight = (x[order] for x in (node, length, unit, weight))
        head = np.append(True, node[1:] != node[:-1])
        # Backward sums: nodes by their distance from the end of their chunk, all chunks at once.
        left = end[node] - node
        by_left = np.argsort(left.astype(np.uint16) if left.max() < 1 << 16 else left, kind="stable")
        cuts = np.searchsorted(left[by_left], np.arange(1, left.max() + 2))
        mass, ways = np.zeros(len(code) + 1), np.ones(len(code) + 1)
        share = np.zeros(len(node))
        for distance, (lo, hi) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True), 1):
            edge = by_left[lo:hi]
            size = length[edge]
            target = np.where(size < distance, node[edge] + size, len(code))  # the last entry stands for a chunk's end
            got = weight[edge] + mass[target]
            runs = np.flatnonzero(head[edge])
            at = node[edge[runs]]
            mass[at] = np.logaddexp.reduceat(got, runs)
            ways[at] = np.minimum(np.add.reduceat(ways[target], runs), 2.0**60)
            share[edge] = got - mass[node[edge]]
        # Running sums of each node's edges by themselves: a text's draws do not depend on its batch.
        first = np.flatnonzero(head)
        count = np.diff(np.append(first, len(node)))
        upto = np.exp(share)
        at, left = first, count
        for _ in range(1, count.max()):
            at, left = at[left > 1] + 1, left[left > 1] - 1
            upto[at] += upto[at - 1]
        # Into the flat arrays, a closing node without edges after each chunk.
        upto[np.append(first[1:], len(node)) - 1] = 1.0
        share[np.repeat(count, count) == 1] = 0.0
        chunk_of = np.repeat(np.arange(len(chunks)), sizes)
        out = np.zeros(len(code) + len(chunks), np.int64)
        out[np.arange(len(code)) + chunk_of] = count
        to = self.nodes + node + length + chunk_of[node]
        starts = self.nodes + np.cumsum(sizes + 1) - sizes - 1
        self.start, self.ways = _put(self.start, len(self.known) - len(chunks), starts), _put(self.ways, len(self.known) - len(chunks), ways[stop - sizes])
        self.first = _put(self.first, self.nodes + 1, self.edges + np.cumsum(out))
        self.to, self.unit = _put(self.to, self.edges, to), _put(self.unit, self.edges, unit)
        self.upto, self.log_p = _put(self.upto, self.edges, upto), _put(self.log_p, self.edges, share)
        self.nodes, self.edges = self.nodes + len(out), self.edges + len(to)

    def unit_table(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(number of ids of each unit, where they begin, all ids)."""
        if len(self.table[0]) < len(self.units):
            size = np.fromiter(map(len, self.units), np.int64, len(self.units))
            self.table = size, np.cumsum(size) - size, np.fromiter((i for u in self.units for i in u), np.int64, int(size.sum()))
        return self.table

    def walk(self, start: np.ndarray, seed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ancestral draws: (units per chunk, units in order, log probability per chunk)."""
        node, at = start.astype(np.int64), np.arange(len(start))
        count, log_p = np.zeros(len(start), np.int64), np.zeros(len(start))
        taken: list[tuple[np.ndarray, np.ndarray]] = []
        step = 0
        while len(at):
            edge, last = self.first[node], self.first[node + 1]
            open_ = edge < last
            if not open_.all():
                at, node, edge = at[open_], node[open_], edge[open_]
                if not len(at):
                    break
            u = uniform(seed[at], step)
            more = np.flatnonzero(u >= self.upto[edge])
            while len(more):
                edge[more] += 1
                more = more[u[more] >= self.upto[edge[more]]]
            taken.append((at, self.unit[edge]))
            count[at] += 1
            log_p[at] += self.log_p[edge]
            node = self.to[edge]
            step += 1
        units = np.zeros(count.sum(), np.int64)
        begin = np.cumsum(count) - count
        for i, (at, unit) in enumerate(taken):
            units[begin[at] + i] = unit
        return count, units, log_p


def _put(array: np.ndarray, at: int, values) -> np.ndarray:
    """``array`` with values written from ``at`` on, in twice the room where it is full."""
    end = at + len(values)
    if end > len(array):
        array = np.concatenate([array[:at], np.zeros(max(end, 2 * len(array)) - at, array.dtype)])
    array[at:end] = values
    return array


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def uniform(seed: np.ndarray, number: int) -> np.ndarray:
    """The number-th uniform draw in (0, 1) of each seed."""
    with np.errstate(over="ignore"):
        x = _mix(seed + np.uint64(number + 1) * _STEP)
    return ((x >> np.uint64(12)).astype(np.float64) + 0.5) / float(1 << 52)


def _seeds(seeds: np.ndarray, sample: int, first: np.ndarray, stop: np.ndarray, turn: int = 0) -> np.ndarray:
    """A seed for each chunk from first to stop of each text's sample, text after text."""
    size = stop - first
    with np.errstate(over="ignore"):
        root = _mix(seeds + np.uint64(sample * 1_000_003 + turn + 1) * _M2)
        at = np.arange(size.sum()) + np.repeat(first - (np.cumsum(size) - size) + 1, size)
        return _mix(np.repeat(root, size) + at.astype(np.uint64) * _M1)


def _truncated(log_mass: np.ndarray, top: float, u: np.ndarray) -> np.ndarray:
    """Gumbel draws with these locations, given that they are below ``top``."""
    return log_mass - np.logaddexp(log_mass - top, np.log(-np.log(u)))


class Sample:
    """One drawn segmentation of a text: units and log probability by chunk, and the parts around it still to search.

    ``best[i]`` is the perturbed score of the part that agrees with this sample before chunk
    first + i and differs there from it and from ``others`` (earlier draws of that part).
    """

    def __init__(self, count: np.ndarray, units: np.ndarray, log_p: np.ndarray, score: float) -> None:
        self.count, self.units, self.log_p, self.score = count, units, log_p, score
        self.first, self.others, self.best = 0, [], np.zeros(0)

    def chunk_units(self, i: int) -> tuple:
        lo = int(self.count[:i].sum())
        return tuple(self.units[lo : lo + int(self.count[i])].tolist())

    def open_parts(self, ways: np.ndarray, u: np.ndarray, first: int, others: list[tuple[tuple, float]]) -> None:
        """``u``: a uniform draw for each chunk from ``first`` on. ``others``: (units, log probability) of the segmentations of chunk ``first`` drawn before in this part."""
        self.first, self.others = first, others
        before = np.cumsum(self.log_p) - self.log_p
        left = -np.expm1(self.log_p[first:])
        tried = np.ones(len(left), np.int64)
        if len(left):
            left[0] -= sum(np.exp(x) for _, x in others)
            tried[0] += len(others)
        with np.errstate(divide="ignore"):
            mass = np.where(ways[first:] > tried, np.log(np.maximum(left, 0.0)), -np.inf) + before[first:]
        self.best = _truncated(mass, self.score, u)


class Text:
    """A text's chunks and the samples drawn from it."""

    def __init__(self, seed: int, start: np.ndarray, ways: np.ndarray) -> None:
        self.seed, self.start, self.ways = seed, start, ways
        self.samples: list[Sample] = []

    def next_part(self) -> tuple[float, int, int]:
        """(perturbed score, sample, chunk) of the best part left; -inf when all is drawn."""
        top = (-np.inf, 0, 0)
        for s, x in enumerate(self.samples):
            if len(x.best):
                i = int(np.argmax(x.best))
                top = max(top, (float(x.best[i]), s, i + x.first))
        return top


class Encoder:
    """Encodes texts in batches; keeps the lattices of the chunks it has met."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.lattices = Lattices(vocabulary)

    def _prepare(self, texts: list[str], seeds: list[int]) -> list[Text]:
        lattices = self.lattices
        if lattices.nodes > KEEP_NODES:
            lattices.clear()
        cut = [CHUNK.findall(" " + t) if t else [] for t in texts]
        size = np.cumsum([0, *map(len, cut)])
        number = np.fromiter(map(lattices.known.__getitem__, chain.from_iterable(cut)), np.int64, size[-1])
        lattices.add()
        start, ways = lattices.start[number], lattices.ways[number]
        return [Text(seed, start[a:b], ways[a:b]) for seed, a, b in zip(seeds, size[:-1].tolist(), size[1:].tolist(), strict=True)]

    def _draw(self, starts: list[np.ndarray], seeds: np.ndarray) -> list[tuple]:
        """(count, units, log_p) of ancestral draws for each run of chunks, all walked together."""
        sizes = np.cumsum([0, *map(len, starts)])
        if not sizes[-1]:
            return [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))] * len(starts)
        count, units, log_p = self.lattices.walk(np.concatenate(starts), seeds)
        upto = np.concatenate(([0], np.cumsum(count)))
        return [(count[a:b], units[upto[a] : upto[b]], log_p[a:b]) for a, b in zip(sizes[:-1].tolist(), sizes[1:].tolist(), strict=True)]

    def sample(self, texts: list[str], seeds: list[int], k: int) -> list[tuple[list[Sample], float]]:
        """Per text: up to k samples, best perturbed score first, and the threshold kappa."""
        work = self._prepare(texts, seeds)
        if not work:
            return []
        seed = np.array([x & (2**64 - 1) for x in seeds], np.uint64)
        size = np.array([len(t.start) for t in work])
        none = np.zeros(len(work), np.int64)
        root = -np.log(-np.log(uniform(_seeds(seed, 0, none, none + 1, 1), 0)))
        noise = np.split(uniform(_seeds(seed, 0, none, size, 2), 0), np.cumsum(size)[:-1])
        first = self._draw([t.start for t in work], _seeds(seed, 0, none, size))
        for t, draw, score, u in zip(work, first, root.tolist(), noise, strict=True):
            t.samples.append(Sample(*draw, score=score))
            t.samples[0].open_parts(t.ways, u, 0, [])
        for number in range(1, k):
            todo = [(t, *part) for t in work if len(t.samples) == number and (part := t.next_part())[0] > -np.inf]
            if not todo:
                break
            seed = np.array([t.seed & (2**64 - 1) for t, *_ in todo], np.uint64)
            size, at = np.array([len(t.start) for t, *_ in todo]), np.array([i for *_, i in todo])
            noise = np.split(uniform(_seeds(seed, number, at, size, 2), 0), np.cumsum(size - at)[:-1])
            differ = self._differing(todo, seed, at, number)
            rest = self._draw([t.start[i + 1 :] for t, _, _, i in todo], _seeds(seed, number, at + 1, size))
            for (t, score, s, i), (units, log_p), after, u in zip(todo, differ, rest, noise, strict=True):
                old = t.samples[s]
                others = [(old.chunk_units(i), float(old.log_p[i])), *(old.others if i == old.first else [])]
                lo = int(old.count[:i].sum())
                new = Sample(
                    np.concatenate([old.count[:i], [len(units)], after[0]]),
                    np.concatenate([old.units[:lo], units, after[1]]).astype(np.int64),
                    np.concatenate([old.log_p[:i], [log_p], after[2]]),
                    score,
                )
                old.best[i - old.first] = -np.inf  # from here on searched as the new sample's part
                new.open_parts(t.ways, u, i, others)
                t.samples.append(new)
        return [(t.samples, t.next_part()[0]) for t in work]

    def _exits(self, start: int, drawn: list[tuple]) -> list[tuple[float, tuple, int, int, int]]:
        """Where a segmentation of a chunk can leave all of those drawn: (log probability so far, one of them,
        number of units shared with it, unit taken instead, node reached)."""
        x = self.lattices
        found, todo = [], [(start, 0.0, 0, drawn)]
        while todo:
            node, log_p, depth, active = todo.pop()
            onward: dict[int, list] = {}
            for path in active:
                if depth < len(path):
                    onward.setdefault(path[depth], []).append(path)
            edges = slice(int(x.first[node]), int(x.first[node + 1]))
            for to, unit, p in zip(x.to[edges].tolist(), x.unit[edges].tolist(), x.log_p[edges].tolist(), strict=True):
                if unit in onward:
                    todo.append((to, log_p + p, depth + 1, onward[unit]))
                else:
                    found.append((log_p + p, active[0], depth, unit, to))
        return found

    def _differing(self, todo: list, seed: np.ndarray, at: np.ndarray, number: int) -> list[tuple[tuple, float]]:
        """For each (text, part) a segmentation of the part's chunk that was not drawn in it before: (units, log probability).

        Drawn exactly: first where it leaves the drawn ones, then the rest of the way.
        """
        u = uniform(_seeds(seed, number, at, at + 1, 3), 0).tolist()
        heads, nodes = [], []
        for (t, _, s, i), draw in zip(todo, u, strict=True):
            old = t.samples[s]
            drawn = [old.chunk_units(i), *(x for x, _ in old.others if i == old.first)]
            exits = self._exits(int(t.start[i]), drawn)
            weight = np.exp(np.array([e[0] for e in exits]) - max(e[0] for e in exits))
            log_p, path, depth, unit, node = exits[min(int(np.searchsorted(np.cumsum(weight), draw * weight.sum(), side="right")), len(exits) - 1)]
            heads.append(((*path[:depth], unit), log_p))
            nodes.append(np.array([node]))
        rest = self._draw(nodes, _seeds(seed, number, at, at + 1, 4))
        return [((*units, *more.tolist()), log_p + float(p[0])) for (units, log_p), (_, more, p) in zip(heads, rest, strict=True)]

    def ids(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(piece ids, number of ids before each unit and in all)."""
        size, begin, flat = self.lattices.unit_table()
        n = size[units]
        upto = np.concatenate(([0], np.cumsum(n)))
        return flat[np.repeat(begin[units] - upto[:-1], n) + np.arange(upto[-1])], upto


def log_inclusion(log_p: float, kappa: float) -> float:
    """log of 1 - exp(-exp(log_p - kappa)), stable at both ends."""
    x = log_p - kappa
    if x < -30:
        return x
    return float(np.log(-np.expm1(-np.exp(min(x, 700.0)))))


SAMPLE_TYPE = "array<struct<ids:array<int>,log_p:double,log_inclusion:double,round_trip:boolean>>"


def decoded(table: np.ndarray, ids: np.ndarray) -> str:
    """The text of piece ids; ``table`` holds the bytes of each piece."""
    return b"".join(table[ids].tolist()).decode("utf-8", "replace")[1:]


class Bytes:
    """The bytes of all pieces in one buffer, for decoding many samples at once."""

    def __init__(self, vocabulary_bytes: list[bytes]) -> None:
        self.flat = np.frombuffer(b"".join(vocabulary_bytes), np.uint8)
        self.size = np.fromiter(map(len, vocabulary_bytes), np.int64, len(vocabulary_bytes))
        self.begin = np.cumsum(self.size) - self.size

    def equal(self, ids: np.ndarray, cuts: np.ndarray, texts: list[str]) -> np.ndarray:
        """Whether the ids from each cut to the next decode to each text, byte for byte, behind a space unless there are none."""
        size = self.size[ids]
        upto = np.concatenate(([0], np.cumsum(size)))
        back = self.flat[np.repeat(self.begin[ids] - upto[:-1], size) + np.arange(upto[-1])]
        coded = [b" " + t.encode() if t else b"" for t in texts]
        want = np.frombuffer(b"".join(coded), np.uint8)
        ends = np.cumsum([0, *map(len, coded)])
        if len(back) == len(want) and (upto[cuts] == ends).all() and (back == want).all():
            return np.ones(len(texts), bool)
        return np.array([back[upto[a] : upto[b]].tobytes() == c for a, b, c in zip(cuts[:-1], cuts[1:], coded, strict=True)], bool)


def byte_table(vocabulary_bytes: list[bytes]) -> np.ndarray:
    return np.array([*vocabulary_bytes, b""], dtype=object)[:-1]


def encode(docs: DataFrame, k: int = SAMPLES, model: str = MODEL) -> DataFrame:
    """doc_id and ``samples``: for each text up to k distinct segmentations, best perturbed score first.

    A sample has its piece ids, log probability, log inclusion score, and whether its ids
    decode to the text.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(load(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, table = Encoder(shared.value), Bytes(shared.value.bytes_of)
        for b in batches:
            texts, seeds = b.column(1).to_pylist(), b.column(2).to_pylist()
            lo, size = 0, 0
            for hi, text in enumerate(texts, 1):
                size += len(text or "")
                if size >= BATCH_CHARS or hi == len(texts):
                    samples = encoded(encoder, table, texts[lo:hi], seeds[lo:hi])
                    yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), samples], names=["doc_id", "samples"])
                    lo, size = hi, 0

    def encoded(encoder: Encoder, table: Bytes, texts: list, seeds: list) -> pa.Array:
        some = [i for i, t in enumerate(texts) if t is not None]
        drawn = encoder.sample([texts[i] for i in some], [seeds[i] for i in some], k)
        per_text = np.zeros(len(texts), np.int64)
        per_text[some] = [len(s) for s, _ in drawn]
        every = [(x, kappa) for samples, kappa in drawn for x in samples]
        flat, upto = encoder.ids(np.concatenate([x.units for x, _ in every]) if every else np.zeros(0, np.int64))
        ends = np.cumsum([0, *(len(x.units) for x, _ in every)])
        log_p = [float(x.log_p.sum()) for x, _ in every]
        cuts = upto[ends]
        whose = np.repeat(np.arange(len(texts)), per_text).tolist()
        back = table.equal(flat, cuts, [texts[i] for i in whose])
        ids = pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(flat.astype(np.int32)))
        fields = [ids, pa.array(log_p, pa.float64()), pa.array([log_inclusion(p, kappa) for p, (_, kappa) in zip(log_p, every, strict=True)], pa.float64()), pa.array(back, pa.bool_())]
        structs = pa.StructArray.from_arrays(fields, names=["ids", "log_p", "log_inclusion", "round_trip"])
        return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(per_text))).astype(np.int32)), structs)

    seed = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), text_key())
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), seed.alias("seed"))
    return rows.mapInArrow(run, f"doc_id long, samples {SAMPLE_TYPE}")


def decode(rows: DataFrame, ids: Column, keep: list[str], model: str = MODEL) -> DataFrame:
    """The columns ``keep`` and ``decoded``: the texts of an array of piece-id arrays (null where it is null)."""
    shared = rows.sparkSession.sparkContext.broadcast(load(model).bytes_of)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = byte_table(shared.value)
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                texts = []
                for lists in part.column(len(keep)):
                    texts.append([decoded(table, x.values.to_numpy()) for x in lists] if lists.is_valid else None)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(texts, pa.list_(pa.string()))], names=[*keep, "decoded"])

    asked = rows.select(*keep, ids.alias("ids"))
    schema = ", ".join(f"`{c}` {t}" for c, t in asked.dtypes[:-1]) + ", decoded array<string>"
    return asked.mapInArrow(run, schema)


def sampled(docs: DataFrame, k: int = SAMPLES, model: str = MODEL) -> DataFrame:
    """One row per document and sample: rank, n_pieces, log_p, log_inclusion, ids_hash and round_trip (decoded text equals the text)."""
    each = encode(docs, k, model).select("doc_id", F.posexplode("samples").alias("pos", "x"))
    return each.select(
        "doc_id",
        (F.col("pos") + 1).alias("rank"),
        F.size("x.ids").cast("long").alias("n_pieces"),
        F.col("x.log_p").alias("log_p"),
        F.col("x.log_inclusion").alias("log_inclusion"),
        F.hex(F.xxhash64("x.ids")).alias("ids_hash"),
        F.col("x.round_trip").alias("round_trip"),
    )
