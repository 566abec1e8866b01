"""SentencePiece encoding by Gumbel top-k sampling without replacement, and decoding.

A text's segmentations into vocabulary pieces form a lattice; a segmentation's probability is
the product of its pieces' weights, normalised. Each segmentation has its log probability plus a
Gumbel noise; the k largest perturbed values are k distinct samples without replacement. A
perturbed A-star search finds them without enumerating: a frontier node is a subtree of
segmentations with a common prefix, its priority the exact maximum of its perturbed leaves,
drawn from the subtree's mass (backward sums over the lattice) and truncated at the parent's. The
best node is expanded first; the leaf below it is completed by ancestral sampling. The largest
priority left is the threshold of the inclusion scores log(1 - exp(-exp(log_prob - threshold))).
All noise is hashed from the row key, so results do not depend on partitioning or retries.

The vocabulary file is read on the driver (a parameter) and broadcast; its size is fixed. A BPE
file has ranks, not probabilities; the weight of the piece of rank r is 1 / (r + RANK_SHIFT), a
fixed rule, and nothing is trained. Characters without a piece fall back to UTF-8 bytes. No piece
holds a blank after another character, so the lattice parts at blanks, line breaks and, where the
vocabulary allows, before marks that follow a letter; the distinct chunks of a slice of documents
are solved together in NumPy and kept for the next slices up to a fixed number of places. Memory
is bounded by that, by the slice, or by the longest text.

Defined cases: null and empty text have one segmentation, the empty one (log probability 0,
inclusion 0 on the log scale); a text with fewer than k segmentations gives them all; the blank
mark U+2581 in a text is encoded as bytes; a null key is hashed as such; repeated rows give equal
samples; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import itertools
import math
import re
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free, give_back
from .shingles import M1, M2, M3, mix

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BLANK = "▁"
LATIN = "[A-Za-z\u00c0-\u024f]"
RANK_SHIFT = 10
BYTE_SCORE = -12.0
SIEVE, WIDE_SIEVE = np.uint64(48), np.uint64(46)
ASIDE = 0x250  # code points from here are neither Latin letters nor marks
INVERSE = np.uint64(pow(int(M1), -1, 1 << 64))
#: Characters of text worked on together.
SLICE = 200_000
#: Lattice places kept from slice to slice, about 110 bytes each.
PLACES = 900_000
WIDE, NONE = 0xFFFE, 0xFFFF  # in place of an id: a character encoded as several bytes, no piece
MARK = "\ud800"  # stands for a literal blank mark while chunking; no valid text holds it


def read_vocabulary(path: str = MODEL) -> dict:
    """{"pieces": [(text, id)], "bytes": [id of byte 0..255], "text": [piece or None], "size": n}"""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    special = [sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) for i in range(n)]
    text = [None if s else sp.id_to_piece(i) for i, s in enumerate(special)]
    if n >= WIDE:
        raise ValueError("a vocabulary of 65,534 pieces or more needs wider ids")
    whole = re.compile(f"{BLANK}*[^{BLANK}\n]*")
    return {"text": text, "bytes": [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)],
            "pieces": [(t, i) for i, t in enumerate(text) if t and whole.fullmatch(t)], "size": n}


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def times(n: int, m: np.uint64) -> np.uint64:
    return np.uint64(n * int(m) & 0xFFFFFFFFFFFFFFFF)


def _byte_score(point: np.ndarray) -> np.ndarray:
    return BYTE_SCORE * (1 + (point > 0x7F) + (point > 0x7FF) + (point > 0xFFFF))


class Lattice:
    """Vocabulary tables and the lattices of distinct chunks, kept from slice to slice."""

    def __init__(self, vocabulary: dict):
        self.byte_ids = np.array(vocabulary["bytes"])
        self.weight = -np.log(np.arange(vocabulary["size"]) + float(RANK_SHIFT))
        self.weight[self.byte_ids] = BYTE_SCORE
        # The lattice parts before a mark that no piece has after a Latin letter.
        after = re.compile(LATIN + "([!-/:-@^_`{-~])")
        joined = {m[1] for t, _ in vocabulary["pieces"] for m in after.finditer(t)}
        points = list(map(chr, range(ASIDE + 1)))
        self.latin = np.array([bool(re.match(LATIN, c)) for c in points])
        self.cut = np.array([32 < i < 127 and not c.isalnum() and c not in joined for i, c in enumerate(points)])
        self.tables, heads = {}, {}
        by_length: dict[int, list] = {}
        for t, i in vocabulary["pieces"]:
            by_length.setdefault(len(t), []).append((self._hash(_points(t)), i))
            for n in range(1, len(t)):
                heads.setdefault(n, set()).add(t[:n])
        for n, rows in by_length.items():
            rows.sort()
            keys = np.array([k for k, _ in rows], dtype=np.uint64)
            ids = np.array([i for _, i in rows], dtype=np.int64)
            sieve = np.zeros(1 << 16, dtype=bool)
            sieve[((keys * M2) >> SIEVE).view(np.int64)] = True
            self.tables[n] = (keys, ids, self.weight[ids], sieve)
        self.heads = {}  # by length, a sieve of what longer pieces begin with
        for n, begins in heads.items():
            keys = np.array([self._hash(_points(t)) for t in begins], dtype=np.uint64)
            self.heads[n] = np.zeros(1 << 18, dtype=bool)
            self.heads[n][((keys * M2) >> WIDE_SIEVE).view(np.int64)] = True
        self.longest = max(self.tables)
        self.width = -(-self.longest // 8) * 8
        self.first, self.powers = np.empty(0, dtype=bool), np.empty(0, dtype=np.uint64)
        self.reset(PLACES)

    @staticmethod
    def _hash(points: np.ndarray) -> int:
        h = np.zeros(1, dtype=np.uint64)
        for p in points:
            h = h * M1 + np.uint64(p + 1)
        return int(h[0])

    def reset(self, room: int = 0) -> None:
        """Forget all chunks; make room for ``room`` places at least."""
        self.keys, self.numbers, self.used = np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64), 0
        self.start = self.end = np.empty(0, dtype=np.int64)
        if room > len(self.first):
            self.ids = np.empty((room, self.width), dtype=np.uint16)
            self.point = np.empty(room, dtype=np.uint32)
            self.upto = np.empty((room, self.width), dtype=np.float32)
            self.beta = np.empty(room)
            self.first, self.single = np.empty(room, dtype=bool), np.empty(room, dtype=bool)

    def chunks(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(code points end to end, where each chunk starts, number of chunks before each text).

        A text is taken with a blank before it. A chunk starts at a line break, after one, at a
        run of blanks, and at a mark after the letters that begin a chunk.
        """
        cp = _points("".join([f" {t}" for t in texts if t])).copy()
        bounds = np.concatenate([[0], np.cumsum([len(t) + 1 if t else 0 for t in texts])]).astype(np.int64)
        cp[cp == ord(BLANK)] = ord(MARK)
        blank, line = cp == 32, cp == 10
        cp[blank] = ord(BLANK)
        start = np.zeros(len(cp) + 1, dtype=bool)
        start[:-1] = line | blank
        start[1:] |= line
        start[1:-1] &= ~(blank[1:] & blank[:-1])
        start[bounds] = True
        start = start[:-1]
        small = np.minimum(cp, ASIDE)
        latin = self.latin[small]
        marks = np.flatnonzero(self.cut[small[1:]] & latin[:-1]) + 1 if len(cp) else np.empty(0, dtype=np.int64)
        head = latin.copy()
        head[1:] &= ~latin[:-1]
        runs = np.flatnonzero(head)
        run = runs[np.searchsorted(runs, marks, side="right") - 1] if len(marks) else marks
        start[marks[start[run] | blank[run - 1]]] = True
        starts = np.flatnonzero(start)
        return cp, starts, np.searchsorted(starts, bounds)

    def admit(self, cp: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Number of the chunk at each start; chunks not yet known are solved.

        Chunks are told apart by a 64-bit hash. Solved ones stay for later slices while there is
        room for ``PLACES`` places, or for one slice.
        """
        n = len(cp)
        if n >= len(self.powers):
            self.powers, self.inverse = (np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(2 * n, x)])) for x in (M1, INVERSE))
        sizes = np.diff(starts, append=n)
        value = (cp + np.uint64(1)) * M2
        sums = np.concatenate([[np.uint64(0)], np.cumsum((value ^ (value >> np.uint64(29))) * self.powers[:n])])
        key = mix((sums[starts + sizes] - sums[starts]) * self.inverse[starts] ^ (sizes.astype(np.uint64) * M3))
        keys, spot, which = np.unique(key, return_index=True, return_inverse=True)
        while True:
            at = np.minimum(np.searchsorted(self.keys, keys), max(0, len(self.keys) - 1))
            known = self.keys[at] == keys if len(self.keys) else np.zeros(len(keys), dtype=bool)
            fresh = np.flatnonzero(~known)
            size = sizes[spot[fresh]]
            need = int(size.sum() + len(size))
            if self.used + need <= len(self.first):
                break
            self.reset(max(PLACES, need))
        number = np.empty(len(keys), dtype=np.int64)
        number[known] = self.numbers[at[known]]
        if len(fresh):
            number[fresh] = len(self.keys) + np.arange(len(fresh))
            inside = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
            self.solve(cp[np.repeat(starts[spot[fresh]], size) + inside], size)
            order = np.argsort(np.concatenate([self.keys, keys[fresh]]), kind="stable")
            self.keys = np.concatenate([self.keys, keys[fresh]])[order]
            self.numbers = np.concatenate([self.numbers, number[fresh]])[order]
        return number[which]

    def solve(self, points: np.ndarray, sizes: np.ndarray) -> None:
        """Edges and choice probabilities at each place of chunks laid after those known."""
        base, width = self.used, self.longest
        start = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]  # one end place each
        end = start + sizes
        n = int(sizes.sum() + len(sizes))
        self.used += n
        self.start, self.end = np.concatenate([self.start, start + base]), np.concatenate([self.end, end + base])
        first = self.first[base:base + n]
        first[:] = False
        first[start] = True
        cp = np.zeros(n + width, dtype=np.uint64)
        inner = np.ones(n, dtype=bool)
        inner[end] = False
        places = np.flatnonzero(inner)
        cp[places] = points
        rest = np.zeros(n, dtype=np.int64)
        rest[places] = np.repeat(end, sizes) - places
        score = np.full((n, width), -np.inf)
        ids, upto = self.ids[base:base + n], self.upto[base:base + n]
        ids[:], upto[:] = NONE, 2.0
        self.point[base:base + n] = cp[:n]
        h, at = np.zeros(len(places), dtype=np.uint64), places
        for m in range(1, width + 1):
            if m > 1:
                live = np.flatnonzero((rest.take(at) >= m) & self.heads[m - 1].take(((h * M2) >> WIDE_SIEVE).view(np.int64)))
                at, h = at.take(live), h.take(live)
            if not len(at):
                break
            h = h * M1 + (cp.take(at + m - 1) + np.uint64(1))
            if m not in self.tables:
                continue
            keys, own, weight, sieve = self.tables[m]
            maybe = np.flatnonzero(sieve.take(((h * M2) >> SIEVE).view(np.int64)))
            key = h.take(maybe)
            k = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            hit = np.flatnonzero(keys.take(k) == key)
            where, k = at.take(maybe.take(hit)), k.take(hit)
            score[where, m - 1], ids[where, m - 1] = weight[k], own[k]
        bare = places[np.isneginf(score[places, 0])]
        point = cp[bare].astype(np.int64)
        point[point == ord(MARK)] = ord(BLANK)
        score[bare, 0] = _byte_score(point)
        ids[bare, 0] = np.where(point < 0x80, self.byte_ids[np.minimum(point, 0x7F)], WIDE)
        beta = np.zeros(n + width)  # log mass of the segmentations from a place to its chunk's end
        order = places[np.argsort(rest[places], kind="stable")]
        bound = np.searchsorted(rest[order], np.arange(1, int(sizes.max()) + 2))
        span = np.arange(1, width + 1)
        for d in range(len(bound) - 1):
            p = order[bound[d]:bound[d + 1]]
            w = min(width, d + 1)
            x = score.take(p, axis=0)[:, :w] + beta.take(p[:, None] + span[:w])
            top = x.max(axis=1)
            sums = np.cumsum(np.exp(x - top[:, None]), axis=1)
            total = sums[:, -1:]
            beta[p] = mass = top + np.log(total[:, 0])
            upto[p, :w] = np.where(sums >= total, 2.0, sums / total)  # the last piece takes the rounding
        self.beta[base:base + n] = beta[:n]
        self.single[base:base + n] = (ids != NONE).sum(axis=1) < 2

    def log_q(self, places: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Log probability of each choice: the piece's weight and what the rest weighs after and before it."""
        weight = self.weight.take(ids, mode="clip")
        wide = np.flatnonzero(ids == WIDE)
        if len(wide):
            weight[wide] = _byte_score(self.character(places[wide]))
        return weight + self.beta.take(places + lengths + 1) - self.beta.take(places)

    def character(self, places: np.ndarray) -> np.ndarray:
        point = self.point[places].astype(np.int64)
        point[point == ord(MARK)] = ord(BLANK)
        return point

    def branches(self, place: int) -> list[tuple[int, float]]:
        """(length, log probability) of each piece from a place."""
        row = self.ids[place]
        m = np.flatnonzero(row != NONE)
        return list(zip(m.tolist(), self.log_q(np.full(len(m), place), m, row[m]).tolist(), strict=True))

    def below(self, p: np.ndarray, u: np.ndarray) -> np.ndarray:
        """How many cumulative probabilities at each place are not above ``u``; eight are counted at once."""
        rows = (self.upto.take(p, axis=0) <= u[:, None]).view(np.uint64)
        return np.bitwise_count(rows).sum(axis=1, dtype=np.int64) if rows.shape[1] > 2 else np.add.reduce(
            [np.bitwise_count(rows[:, j]) for j in range(rows.shape[1])], axis=0, dtype=np.int64)

    def draw(self, which: np.ndarray, seed: np.ndarray, stream: int):
        """An ancestral sample of each chunk occurrence: (offsets, places, lengths, ids, log probabilities)."""
        at, end = self.start[which].copy(), self.end[which]
        live, step, taken = np.arange(len(which)), 0, []
        count = np.zeros(len(which), dtype=np.int64)
        base = seed + times(stream + 1, M2)
        while len(live):
            p = at.take(live)
            u = (mix(base.take(live) + times(step, M3)) >> np.uint64(40)).astype(np.float32) * np.float32(2.0**-24)
            m = self.below(p, u)
            taken.append((live, p, m))
            count[live] += 1
            at[live] = p + m + 1
            live = live.compress(p + m + 1 < end.take(live))
            step += 1
        offsets = np.concatenate([[0], np.cumsum(count)])
        places, lengths = np.empty(offsets[-1], dtype=np.int64), np.empty(offsets[-1], dtype=np.int64)
        for step, (who, p, m) in enumerate(taken):
            where = offsets[who] + step
            places[where], lengths[where] = p, m
        ids = self.ids.reshape(-1).take(places * self.width + lengths)
        return offsets, places, lengths, ids, self.log_q(places, lengths, ids)


class Noise:
    """Uniform numbers hashed from a seed and a counter."""

    def __init__(self, seed: int):
        self.at = seed

    def uniform(self) -> float:
        self.at = (self.at + 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF
        z = self.at
        z = ((z ^ (z >> 30)) * 0xBF58476D1CE4E5B9) & 0xFFFFFFFFFFFFFFFF
        z = ((z ^ (z >> 27)) * 0x94D049BB133111EB) & 0xFFFFFFFFFFFFFFFF
        return ((z ^ (z >> 31)) >> 11) * 2.0**-53 + 2.0**-54

    def below(self, mass: float, top: float) -> float:
        """A Gumbel value at log mass ``mass``, truncated at ``top``."""
        x = mass - top
        e = -math.log(self.uniform())
        return mass - (x if x > 700 else math.log(math.exp(x) + e))


def top_k(lat: Lattice, k: int, seed: int, stream) -> list[tuple]:
    """([(perturbed, log_prob, places, ids)] of the k best leaves, threshold).

    stream(s) gives (chunk offsets, places, lengths, ids, log probabilities) of the s-th
    independent sample of the text. A frontier node holds the leaves that leave a path at
    ``depth`` or later, less the branches taken out already (``gone``); ``mass`` has the mass of
    its branches by place of leaving.
    """
    noise, heap, out, count = Noise(seed), [], [], itertools.count()

    def push(g, path, depth, mass, gone):
        total = float(mass.sum())
        if total > 0:
            g = noise.below(float(path[4][depth]) + math.log(total), g)
            heapq.heappush(heap, (-g, next(count), path, depth, mass, gone))

    def leaf(g, places, lengths, ids, logq, depth):
        before = np.zeros(len(logq) + 1)
        np.cumsum(logq, out=before[1:])
        out.append((g, float(before[-1]), places, ids))
        if depth < len(places):
            mass = np.exp(before[depth:-1] - before[depth]) * -np.expm1(np.minimum(logq[depth:], 0.0))
            mass[lat.single.take(places[depth:])] = 0.0
            push(g, (places, lengths, ids, logq, before), depth, mass, {})

    leaf(-math.log(-math.log(noise.uniform())), *stream(0)[1:], 0)
    while heap and len(out) < k:
        neg, _, path, depth, mass, gone = heapq.heappop(heap)
        g, (places, lengths, ids, logq, before) = -neg, path
        sums = np.cumsum(mass)
        j = min(int(np.searchsorted(sums, noise.uniform() * sums[-1], side="right")), int(np.flatnonzero(mass)[-1]))
        at = depth + j
        p = int(places[at])
        taken = {int(lengths[at]), *gone.get(at, ())}
        open_ = [(m, math.exp(q)) for m, q in lat.branches(p) if m not in taken]
        u = noise.uniform() * sum(x for _, x in open_)
        for choice, x in open_:
            u -= x
            if u < 0:
                break
        mass = mass.copy()
        mass[j] = math.exp(before[at] - before[depth]) * sum(x for m, x in open_ if m != choice)
        push(g, path, depth, mass, gone | {at: (*gone.get(at, ()), choice)})
        # The new leaf: the branch, the rest of its chunk, then an independent sample.
        chunk = int(np.searchsorted(lat.start, p, side="right")) - 1
        # occurrences are counted on the path itself: a chunk starts at its start place
        t = int(np.count_nonzero(lat.first[places[:at + 1]]))
        new_p, new_m, here = [p], [choice], p + choice + 1
        while here < lat.end[chunk]:
            m = int((lat.upto[here] <= noise.uniform()).sum())
            new_p.append(here)
            new_m.append(m)
            here += m + 1
        new_p, new_m = np.array(new_p), np.array(new_m)
        new_ids = lat.ids[new_p, new_m]
        offsets, *after = stream(len(out))
        new = (new_p, new_m, new_ids, lat.log_q(new_p, new_m, new_ids))
        leaf(g, *(np.concatenate([a[:at], b, c[offsets[t]:]]) for a, b, c in zip(path, new, after, strict=False)), at + 1)
    return out, (-heap[0][0] if heap else -math.inf)


def encode_slice(lat: Lattice, keys: list, texts: list[str], k: int):
    """For each text: ([(ids, log_prob, perturbed)], threshold)."""
    cp, starts, ends = lat.chunks(texts)
    which = lat.admit(cp, starts)
    seeds = np.array([xxhash.xxh3_64_intdigest(repr(x)) for x in keys], dtype=np.uint64)
    n = np.diff(ends)
    spot = np.arange(len(which)) - np.repeat(ends[:-1], n)
    seed = mix(np.repeat(seeds, n) + spot.astype(np.uint64) * M1)
    drawn = [lat.draw(which, seed, s) for s in range(k)]
    for i in range(len(texts)):
        lo, hi = ends[i], ends[i + 1]
        if lo == hi:
            yield [(np.empty(0, dtype=np.int64), 0.0, 0.0)], -math.inf
            continue

        def stream(s, lo=lo, hi=hi):
            offsets, *parts = drawn[s]
            a, b = offsets[lo], offsets[hi]
            return offsets[lo:hi + 1] - a, *(x[a:b] for x in parts)

        found, threshold = top_k(lat, k, int(seeds[i]), stream)
        yield [(_flat(lat, places, ids), logp, g) for g, logp, places, ids in found], threshold


def _flat(lat: Lattice, places: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The ids with each wide character as the ids of its bytes."""
    wide = np.flatnonzero(ids == WIDE)
    if not len(wide):
        return ids
    out, last = [], 0
    for i, point in zip(wide.tolist(), lat.character(places[wide]).tolist(), strict=True):
        out += [ids[last:i], lat.byte_ids[list(chr(point).encode("utf-8", "surrogatepass"))].astype(ids.dtype)]
        last = i + 1
    return np.concatenate([*out, ids[last:]])


class Decoder:
    """ids -> text."""

    def __init__(self, vocabulary: dict):
        byte_of = {i: bytes([b]) for b, i in enumerate(vocabulary["bytes"])}
        self.raw = [byte_of.get(i) or (t or "").replace(BLANK, " ").encode() for i, t in enumerate(vocabulary["text"])]
        self.flat = np.frombuffer(b"".join(self.raw), dtype=np.uint8)
        self.size = np.array([len(r) for r in self.raw])
        self.at = np.cumsum(self.size) - self.size

    def __call__(self, ids) -> str:
        raw = b"".join(itemgetter(*ids)(self.raw)) if len(ids) > 1 else b"".join(self.raw[i] for i in ids)
        return (raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "replace")

    def gives(self, ids: list[np.ndarray], texts: list[str]) -> list[bool]:
        """Whether each id sequence decodes to its text: all decoded together, one by one where any differs."""
        if not ids:
            return []
        flat = np.concatenate(ids)
        n = self.size.take(flat)
        ends = np.cumsum(n)
        raw = self.flat.take(np.arange(int(n.sum())) + np.repeat(self.at.take(flat) - (ends - n), n))
        want = [f" {t}".encode("utf-8", "surrogatepass") if t else b"" for t in texts]
        sizes = np.diff(np.concatenate([[0], ends])[np.cumsum([len(x) for x in ids])], prepend=0)
        if sizes.tolist() == list(map(len, want)) and raw.tobytes() == b"".join(want):
            return [True] * len(texts)
        return [self(x.tolist()) == t for x, t in zip(ids, texts, strict=True)]


def sample_encode(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 2, model: str = MODEL,
                  with_ids: bool = True) -> DataFrame:
    """(key, sample, n_pieces, log_prob, perturbed, inclusion, round_trip[, ids]): up to k rows a text."""
    held = docs.sparkSession.sparkContext.broadcast(read_vocabulary(model))  # fixed size
    kind = docs.schema[key].dataType.simpleString()
    names = ["k", "sample", "n_pieces", "log_prob", "perturbed", "inclusion", "round_trip"] + ["ids"] * with_ids
    types = [kind, "int", "int", "double", "double", "double", "boolean"] + ["array<int>"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lat, decode = Lattice(held.value), Decoder(held.value)
        for batch in give_back(batches):
            keys, texts = batch.column(0), batch.column(1).to_pylist()
            lo = 0
            while lo < len(texts):
                hi, size = lo, 0
                while hi < len(texts) and (hi == lo or size + len(texts[hi] or "") <= SLICE):
                    size += len(texts[hi] or "")
                    hi += 1
                part = [t or "" for t in texts[lo:hi]]
                take, cols, ids = [], [], []
                for i, (found, threshold) in enumerate(encode_slice(lat, keys[lo:hi].to_pylist(), part, k)):
                    for s, (x, logp, g) in enumerate(found):
                        cut = math.exp(min(700.0, logp - threshold)) if threshold > -math.inf else math.inf
                        take.append(lo + i)
                        ids.append(x)
                        cols.append((s, len(x), logp, g, math.log(-math.expm1(-cut)) if cut > 1e-300 else logp - threshold))
                same = decode.gives(ids, [part[i - lo] for i in take])
                cols = [(*c, x) for c, x in zip(cols, same, strict=True)]
                out = [keys.take(pa.array(take, pa.int64())), *[
                    pa.array([c[j] for c in cols], t) for j, t in enumerate(
                        (pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.float64(), pa.bool_()))]]
                if with_ids:
                    ends = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                    flat = np.concatenate(ids).astype(np.int32) if ids else np.empty(0, dtype=np.int32)
                    out.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)))
                yield pa.RecordBatch.from_arrays(out, names=names)
                lo = hi

    schema = ", ".join(f"{n} {t}" for n, t in zip(names, types, strict=True))
    return docs.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInArrow(run, schema).withColumnRenamed("k", key)


def decode(encoded: DataFrame, ids: str = "ids", model: str = MODEL) -> DataFrame:
    """Add ``decoded``, the text of each id sequence; null ids give null. The input's columns stay."""
    held = encoded.sparkSession.sparkContext.broadcast(read_vocabulary(model))

    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        one = Decoder(held.value)
        for ids in batches:
            yield pa.array([None if x is None else one(x) for x in ids.to_pylist()], pa.string())

    return encoded.select("*", run(F.col(ids)).alias(free(encoded, "decoded")))


def op2_gumbel_top_k(spark, sf_dir):
    from .common import table

    return sample_encode(table(spark, sf_dir, "documents"))
