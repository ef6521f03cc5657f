"""Benchmark decontamination.

The benchmark's word n-grams are broadcast as texts and every task builds a hash
set of them: the windows' hashes, sorted, over one buffer of the words. A larger
benchmark goes round by round, one bounded part at a time: between rounds the
documents are written with the words hit so far, and the part is let go.
Documents are scanned in Arrow batches: rolling hashes of all word windows at
once, a bit table as first sieve, and a comparison of the words themselves for
each candidate.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightlake.llm.common import materialise, window_hashes, without, words

N_GRAM = 10
#: Bytes of benchmark text in one broadcast.
MAX_BROADCAST = 32 << 20
#: Characters of documents that are put into one array.
CHUNK = 2 << 20
_SIEVE_BITS = 20


class WindowIndex:
    """Hash set of the windows of some (item number, text) pairs. For each window
    it has a hash, the place of its first word and its item: some 16 bytes, and
    the words once, as bytes with their ends."""

    def __init__(self, items: list[tuple[int, str]], n: int = N_GRAM):
        text = bytearray()
        ends: list[np.ndarray] = []
        windows: dict[int, list[tuple[np.ndarray, int, int]]] = {}
        first = 0
        for number, t in items:
            w = words(t)
            k = min(n, len(w))
            if not k:
                continue
            ends.append(len(text) + np.cumsum([len(x) + 1 for x in w]))
            text += b" ".join(w) + b" "
            windows.setdefault(k, []).append((window_hashes(word_hashes(w), k), first, number))
            first += len(w)
        self.text = bytes(text)
        del text
        # Word i is text[ends[i]:ends[i + 1] - 1].
        self.ends = np.concatenate([[0], *ends]).astype(np.uint32 if len(self.text) < 1 << 32 else np.int64)
        del ends
        self.by_size: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = {}
        for k in list(windows):
            parts = windows.pop(k)
            hashes = np.concatenate([h for h, _, _ in parts])
            starts = np.concatenate([np.arange(at, at + len(h), dtype=np.uint32) for h, at, _ in parts])
            numbers = np.repeat(np.array([i for _, _, i in parts], dtype=np.int32), [len(h) for h, _, _ in parts])
            order = np.argsort(hashes, kind="stable")
            sieve = np.zeros(1 << _SIEVE_BITS, dtype=bool)
            sieve[hashes >> np.uint64(64 - _SIEVE_BITS)] = True
            self.by_size[k] = sieve, hashes[order], starts[order], numbers[order]

    def found(self, k: int, low: int, high: int, window: bytes) -> set[int]:
        """Items that have a window among those from ``low`` to ``high``."""
        _, _, starts, numbers = self.by_size[k]
        out = set()
        for at, number in zip(starts[low:high].tolist(), numbers[low:high].tolist()):
            if number not in out and self.text[self.ends[at]:self.ends[at + k] - 1] == window:
                out.add(number)
        return out

    def scan(self, texts: list[str | None]) -> Iterator[tuple[int, np.ndarray, set[int]]]:
        """For each text: number of words, which of them are hit, items found."""
        token_lists = [words(t) for t in texts]
        ends = np.cumsum([len(t) for t in token_lists])
        flat = [w for t in token_lists for w in t]
        h = word_hashes(flat)
        hit = np.zeros(len(flat) + 1, dtype=np.int32)  # +1 where a window begins, -1 behind it
        items: dict[int, set[int]] = {}
        for k, (sieve, hashes, _, _) in self.by_size.items():
            rolled = window_hashes(h, k)
            maybe = np.flatnonzero(sieve[(rolled >> np.uint64(64 - _SIEVE_BITS)).astype(np.int64)])
            low = np.searchsorted(hashes, rolled[maybe], side="left")
            high = np.searchsorted(hashes, rolled[maybe], side="right")
            known: dict[bytes, set[int]] = {}
            for i in np.flatnonzero(low < high).tolist():
                at = int(maybe[i])
                window = b" ".join(flat[at:at + k])
                numbers = known.get(window)
                if numbers is None:
                    numbers = known[window] = self.found(k, int(low[i]), int(high[i]), window)
                if numbers:
                    doc = int(np.searchsorted(ends, at, side="right"))
                    if at + k <= ends[doc]:  # else it runs into the next text
                        hit[at] += 1
                        hit[at + k] -= 1
                        items.setdefault(doc, set()).update(numbers)
        covered = np.cumsum(hit[:-1]) > 0
        start = 0
        for doc, end in enumerate(ends.tolist()):
            yield end - start, covered[start:end], items.get(doc, set())
            start = end


def word_hashes(tokens) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), dtype=np.uint64, count=len(tokens))


def chunks(texts: list[str | None], limit: int = CHUNK) -> Iterator[list[str | None]]:
    """Consecutive texts of about ``limit`` characters together, each counted
    with 256 more; a longer text is alone."""
    part: list[str | None] = []
    size = 0
    for t in texts:
        own = len(t or "") + 256
        if part and size + own > limit:
            yield part
            part, size = [], 0
        part.append(t)
        size += own
    if part:
        yield part


def cut_spans(text: str, hit: np.ndarray) -> str:
    """The text less its hit words and what separates them from each other."""
    out, at, word, inside = [], 0, -1, False
    last_hit_end = None
    for i, ch in enumerate(text):
        is_word = ch >= "\x80" or ch.isalnum()
        if is_word and not inside:
            word += 1
            if hit[word]:
                if last_hit_end is None:
                    out.append(text[at:i])
            elif last_hit_end is not None:
                out.append(text[last_hit_end:i])
                at, last_hit_end = i, None
        inside = is_word
        if is_word and hit[word]:
            last_hit_end = i + 1
    out.append(text[at:] if last_hit_end is None else text[last_hit_end:])
    return "".join(out)


def find_contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
                       item_text: str = "text", n: int = N_GRAM, spans: bool = False,
                       keep: list[str] | None = None, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """``docs`` with n_words, n_hit, items (sorted ids as strings) and, with
    ``spans``, ``clean_text`` (the text less all hit words).

    A window is ``n`` consecutive words of an item; an item of fewer words is
    one window, one of none has no window. Rows with the same item_id are one
    item; the windows of a row without an id count as hits but name no item.
    Null and empty texts have no words and no hits (clean_text keeps them as
    they are). Columns with the names of the results are replaced. ``keep``
    limits the columns of ``docs`` that the result carries (default: all).

    A benchmark of more than ``max_broadcast`` bytes takes as many rounds as it has
    such parts; a worker holds one part (under ten bytes for each of its text's).
    """
    bench = (benchmark.select(F.col(item_id).cast("string").alias("id"), F.col(item_text).alias("text"))
             .filter(F.col("text").isNotNull()).distinct())
    part_bytes = F.sum(F.octet_length("text") + 16).alias("b")
    total = bench.agg(part_bytes).first()["b"] or 0
    rounds = -(-total // max_broadcast) or 1
    results = without(docs, "n_words", "n_hit", "items", "clean_text", "__hit")
    for r in range(rounds):
        rows = bench.filter(F.pmod(F.xxhash64("text"), F.lit(rounds)) == r).collect()
        results, part = _scan_round(results, [(x["id"], x["text"]) for x in rows], text, n, first=r == 0,
                                    last=r == rounds - 1, spans=spans, keep=keep)
        if r < rounds - 1:
            results = materialise(results, "scanned")
            part.unpersist()
    return results


def _scan_round(docs: DataFrame, items: list[tuple[str | None, str]], text: str, n: int, first: bool, last: bool,
                spans: bool, keep: list[str] | None) -> tuple[DataFrame, Broadcast]:
    """Scan for one bounded part of the benchmark (and that part). Between parts
    the hit words travel as a packed bit map in ``__hit``."""
    shared = docs.sparkSession.sparkContext.broadcast(items)
    carried = [f for f in docs.schema.fields if f.name not in ("n_words", "n_hit", "items", "__hit")
               and (not last or keep is None or f.name in keep)]
    added = "n_words long, n_hit long, items array<string>"
    if not last:
        added += ", __hit binary"
    elif spans:
        added += ", clean_text string"
    out_schema = T.StructType(carried + T.StructType.fromDDL(added).fields)
    needed = {f.name for f in carried} | {text} | (set() if first else {"items", "__hit"})
    docs = docs.select([c for c in docs.columns if c in needed])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = shared.value
        index = WindowIndex([(i, t) for i, (_, t) in enumerate(ids)], n)
        for batch in batches:
            texts = batch.column(text).to_pylist()
            n_words, n_hit, names, packed, clean = [], [], [], [], []
            row = 0
            old_hit = None if first else batch.column("__hit").to_pylist()
            old_items = None if first else batch.column("items").to_pylist()
            for part in chunks(texts):
                for count, hit, found in index.scan(part):
                    found_ids = {ids[i][0] for i in found} - {None}
                    if not first:
                        hit = hit | np.unpackbits(np.frombuffer(old_hit[row], np.uint8), count=count).astype(bool)
                        found_ids |= set(old_items[row])
                    n_words.append(count)
                    n_hit.append(int(hit.sum()))
                    names.append(sorted(found_ids))
                    if not last:
                        packed.append(np.packbits(hit).tobytes())
                    elif spans:
                        t = texts[row]
                        clean.append(cut_spans(t, hit) if hit.any() else t)
                    row += 1
            columns = [batch.column(f.name) for f in carried]
            columns += [pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()),
                        pa.array(names, pa.list_(pa.string()))]
            if not last:
                columns.append(pa.array(packed, pa.binary()))
            elif spans:
                columns.append(pa.array(clean, pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in out_schema.fields])

    return docs.mapInArrow(scan, out_schema), shared


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, spans: bool = False, **options) -> DataFrame:
    """Documents without any hit word; with ``spans`` all documents, their hit
    words cut out of the text. Columns as those of ``docs``."""
    found = find_contamination(docs, benchmark, spans=spans, **options)
    if not spans:
        return found.filter("n_hit = 0").select(docs.columns)
    text = options.get("text", "text")
    return found.withColumn(text, F.col("clean_text")).select(docs.columns)
