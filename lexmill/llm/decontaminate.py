"""Benchmark decontamination: size-partitioned MinHash containment search, verified exactly."""

from __future__ import annotations

import re
import sys
from collections import defaultdict
from collections.abc import Iterator
from functools import cache, lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import map_rows, shingle_hashes, slices

WIDTH = 5
BLOCK_BYTES = 8 << 20  # benchmark text of one pass over the documents; larger benchmarks take more passes
AT_ONCE = 200_000  # characters of texts hashed together
MINIMA = 1 << 20  # window minima held at a time
BASE = 0x9E3779B97F4A7C15  # odd, so that its powers have inverses among the 64-bit numbers
_WORD = re.compile(r"\w+")
FOUND = "array<struct<item_id:long,containment:double>>"


def words(text: str | None) -> list[str]:
    """Lower-case runs of letters, digits and underscores."""
    return _WORD.findall(text.lower()) if text else []


def shingles(ws: list[str], width: int = WIDTH) -> set[str]:
    """All runs of ``width`` words; fewer words are one shingle, none have none."""
    width = min(width, len(ws))
    return {" ".join(ws[i:i + width]) for i in range(len(ws) - width + 1)} if width else set()


@cache
def _letters() -> np.ndarray:
    """Code point -> whether it belongs to words."""
    held = np.zeros(sys.maxunicode + 1, dtype=bool)
    for run in _WORD.finditer("".join(map(chr, range(len(held))))):
        held[run.start():run.end()] = True
    return held


def _powers(n: int) -> np.ndarray:
    """The first ``n`` powers of ``BASE``, and of its inverse."""
    out = np.ones((2, n), dtype=np.uint64)
    out[0, 1:], out[1, 1:] = BASE, pow(BASE, -1, 1 << 64)
    return np.cumprod(out, axis=1, dtype=np.uint64)


_usual_powers = lru_cache(maxsize=1)(_powers)


def text_words(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``words`` of all texts one after the other, and how many each text has.

    Words are told apart by the polynomial of their code points, cut out of the running sum
    over a stretch of the texts, which ends with the last word that starts in it; each
    different word is then hashed once.
    """
    lower = [(t or "").lower() + "\n" for t in texts]
    joined = "".join([*lower, "\n"])
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    inside = np.zeros(len(codes) + 1, dtype=bool)
    inside[1:] = _letters()[codes]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    keys = np.empty(len(starts), dtype=np.uint64)
    cuts = np.searchsorted(starts, np.arange(0, len(codes) + AT_ONCE, AT_ONCE))
    for a, b in zip(cuts[:-1], cuts[1:]):
        if a < b:
            low, n = starts[a], ends[b - 1] - starts[a]
            powers, inverses = (_usual_powers(2 * AT_ONCE) if n <= 2 * AT_ONCE else _powers(n))[:, :n]
            sums = np.zeros(n + 1, dtype=np.uint64)
            np.cumsum(codes[low:low + n] * powers, out=sums[1:])
            keys[a:b] = (sums[ends[a:b] - low] - sums[starts[a:b] - low]) * inverses[starts[a:b] - low]
    upto = np.searchsorted(starts, np.cumsum([len(t) for t in lower], dtype=np.int64))
    _, first, place = np.unique(keys, return_index=True, return_inverse=True)
    spans = zip(starts[first].tolist(), ends[first].tolist())
    different = (xxhash.xxh3_64_intdigest(joined[a:b].encode("utf-8", "surrogatepass")) for a, b in spans)
    known = np.fromiter(different, dtype=np.uint64, count=len(first))
    return known[place], np.diff(upto, prepend=0)


def text_shingles(texts: list[str | None], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of all texts one after the other, repeats included, and how many each text has."""
    hashes, own = text_words(texts)
    ends = np.cumsum(own)
    out = np.zeros(len(hashes), dtype=np.uint64)
    if len(hashes) >= width:
        out[:len(hashes) - width + 1] = shingle_hashes(hashes, width)
    whole = np.ones(len(hashes), dtype=bool)
    for n in range(1, width):
        whole[ends[own >= n] - n] = False
    for n in range(1, width):  # texts of fewer words are one shingle
        short = ends[own == n] - n
        if len(short):
            runs = hashes[(short[:, None] + np.arange(n)).ravel()]
            out[short] = shingle_hashes(runs, n)[::n]
            whole[short] = True
    return out[whole], np.where(own >= width, own - width + 1, np.minimum(own, 1))


def _lists(flat: np.ndarray, own: np.ndarray) -> list[np.ndarray]:
    return np.split(flat, np.cumsum(own)[:-1])


def _parts(texts: list[str | None]) -> Iterator[list[str | None]]:
    """The texts in runs of about ``AT_ONCE`` characters."""
    done = total = 0
    for upto, text in enumerate(texts, 1):
        total += len(text or "") + 1
        if total >= AT_ONCE or upto == len(texts):
            yield texts[done:upto]
            done, total = upto, 0


def _slots(values: np.ndarray, held: np.ndarray) -> np.ndarray:
    """Where a table of ``len(held)`` slots, a power of two, has each value."""
    return ((values >> np.uint64(16)) & np.uint64(len(held) - 1)).astype(np.int64)


class Index:
    """MinHash signatures of short items, partitioned by size into powers of two."""

    def __init__(self, items: list[tuple[int, str | None]], permutations: int, width: int, seed: int):
        rng = np.random.default_rng(seed)
        self.width = width
        self.factors = rng.integers(0, 1 << 63, permutations, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.sets = {}
        by_size: dict[int, dict[int, list]] = defaultdict(lambda: defaultdict(list))
        hashed = (h for part in _parts([text for _, text in items]) for h in _lists(*text_shingles(part, width)))
        for (item, text), h in zip(items, hashed):
            if not len(h):
                continue
            key = len(self.sets)
            self.sets[key] = (item, shingles(words(text), width))
            size = 1 << max(0, len(h) - 1).bit_length()
            with np.errstate(over="ignore"):
                for v in (h[None, :] * self.factors[:, None]).min(axis=1).tolist():
                    by_size[size][v].append(key)
        # Signature values of all permutations in one sorted array for each partition, and the slots that they take.
        self.parts = []
        for size in sorted(by_size):
            values = np.array(sorted(by_size[size]), dtype=np.uint64)
            held = np.zeros(1 << min(24, (8 * len(values)).bit_length()), dtype=bool)
            held[_slots(values, held)] = True
            self.parts.append((size, values, held, [by_size[size][v] for v in values.tolist()]))

    def candidates(self, flat: np.ndarray, own: np.ndarray) -> dict[int, set[int]]:
        """place of a document -> items that share a MinHash value with one of its windows.

        ``flat`` has the shingles of all documents, ``own`` how many each has. A window of a
        partition is twice as long as its longest item and starts at every multiple of that
        length, so an item anywhere in a long document meets a window that holds it whole; its
        similarity with it is at least 0.16 at containment 0.8. The minima of a partition are
        taken from those of the next smaller one.
        """
        found: dict[int, set[int]] = defaultdict(set)
        filled = np.flatnonzero(own)
        if not len(filled) or not self.parts:
            return found
        grids = []
        many, below = own[filled], 1
        first = np.cumsum(many) - many
        for size, *part in self.parts:
            ratio = size // below
            n = -(-many // ratio)
            doc = np.repeat(np.arange(len(n)), n)
            start = np.cumsum(n) - n
            starts = first[doc] + (np.arange(len(doc)) - start[doc]) * ratio
            grids.append((starts, filled[doc], doc[1:] == doc[:-1], *part))
            many, below, first = n, size, start
        at_once = max(1, MINIMA // len(grids[0][0]))
        for at in range(0, len(self.factors), at_once):
            low = None
            for starts, doc, next_too, values, held, keys in grids:
                if low is None:
                    low = np.stack([np.minimum.reduceat(flat * f, starts) for f in self.factors[at:at + at_once]])
                else:
                    low = np.minimum.reduceat(low, starts, axis=1)
                wide = low.copy()
                np.minimum(low[:, :-1], low[:, 1:], out=wide[:, :-1], where=next_too)
                hit = np.flatnonzero(held[_slots(wide, held)])
                wanted = wide.ravel()[hit]
                place = np.minimum(np.searchsorted(values, wanted), len(values) - 1)
                same = values[place] == wanted
                for d, k in zip(doc[hit[same] % len(doc)].tolist(), place[same].tolist()):
                    found[d].update(keys[k])
        return found


def _search(index: Index, texts: list[str | None], threshold: float) -> list[list[dict]]:
    out: list[list[dict]] = [[] for _ in texts]
    done = 0
    for part in _parts(texts):
        for k, keys in index.candidates(*text_shingles(part, index.width)).items():
            own = shingles(words(part[k]), index.width)
            for key in keys:
                item, wanted = index.sets[key]
                share = len(wanted & own) / len(wanted)
                if share >= threshold:
                    out[done + k].append({"item_id": item, "containment": share})
        done += len(part)
    return [sorted(x, key=lambda r: (r["item_id"] is None, r["item_id"] or 0)) for x in out]


def mark_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.8, permutations: int = 64,
               width: int = WIDTH, seed: int = 5, text_col: str = "text", item_col: str = "item_id",
               item_text_col: str = "text", name: str = "leaks") -> DataFrame:
    """``docs`` and ``leaks``: the benchmark items of which a whole text holds at least ``threshold`` of the shingles.

    Shingles are runs of five words (letters, digits, underscores, lower case). MinHash
    values propose, and each proposal is verified by exact containment of shingle strings.
    A pass broadcasts the index of at most about ``BLOCK_BYTES`` of benchmark text; a
    larger benchmark is searched block by block. Documents are never shuffled. A text with
    fewer than five words is one shingle, and so only equals an item as short. Null, empty
    and wordless texts and items have no leak; repeated items are reported each; an empty
    benchmark gives empty lists. A column called ``name`` is replaced.
    """
    docs = docs.drop(name)
    items = benchmark.select(F.col(f"`{item_col}`").cast("long").alias("item_id"),
                             F.col(f"`{item_text_col}`").alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    at = docs.columns.index(text_col)
    out = docs.withColumn(name, F.array().cast(FOUND))
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("containment", pa.float64())]))
    for block in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        index = Index([tuple(r) for r in part.collect()], permutations, width, seed)
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def rows(batches, shared=shared):
            index = shared.value
            for batch in slices(batches):
                known = batch.column(batch.num_columns - 1).to_pylist()
                more = _search(index, batch.column(at).to_pylist(), threshold)
                both = [[*(a or []), *b] for a, b in zip(known, more)]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(both, kind)],
                                                 names=batch.schema.names)

        out = map_rows(out, rows, out.schema)
    return out
