"""Phrase collocations by Rabin-Karp fingerprints.

Texts become blocks of word codes with a dictionary of their own. Prefix polynomials over a block's word hashes
give the fingerprint of every n-gram by one subtraction. A block sends its fingerprints to the shuffle as sorted
runs, one a slice of the fingerprints' range, with their counts; the place of an entry in its run is the pointer to
its occurrences. Adding up a slice over all blocks says which entries reach the threshold, and a bit an
entry goes back to the block, where the next length looks at n-grams made of frequent ones alone. At the end the
occurrences behind frequent fingerprints are checked word by word and turned into text, and counts are added up once more
by text: phrases that share a fingerprint fall apart there, and those below the threshold go. Texts of other
phrases are never built.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from litpulse.llm.tokens import hash_pieces
from litpulse.session import materialise

LEAST, LONGEST, BEST = 30, 4, 2000
#: A candidate goes if a longer one around it has this share of its occurrences, in hundredths.
COVERED = 80
SCORE_SCALE = 2_000_000
NO_LANG = "und"
#: Text bytes of a block, about 1.3 million words, and of what is hashed together, so that helper arrays stay small.
BLOCK_BYTES, HASH_BYTES = 8_000_000, 1_000_000
#: Slices of the fingerprints' range at least; there are as many as blocks, so that a slice is about as large as a block.
SLICES = 64
#: Rows of phrases in a record batch.
BATCH_ROWS = 50_000
_BREAKS = np.isin(np.arange(256), [ord(c) for c in ".,;:!?\n\x0b\x0c\r"])
_GAPS = _BREAKS | np.isin(np.arange(256), [32, 9])
#: Base of the polynomials, odd so that its powers have inverses modulo 2**64, and a factor for final mixing.
_BASE, _MIX = 0x9E3779B97F4A7C15, np.uint64(0xFF51AFD7ED558CCD)

BLOCK = "block long, codes binary, size int, words binary, langs array<string>, ends array<int>, n_words array<long>"
_BLOCK = pa.schema(
    [
        ("block", pa.int64()), ("codes", pa.binary()), ("size", pa.int32()), ("words", pa.binary()),
        ("langs", pa.list_(pa.string())), ("ends", pa.list_(pa.int32())), ("n_words", pa.list_(pa.int64())),
    ]
)
RUN = "slice int, block long, keys binary, counts binary"
_RUN = pa.schema([("slice", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])
BITS = "block long, slice int, bits binary"
_BITS = pa.schema([("block", pa.int64()), ("slice", pa.int32()), ("bits", pa.binary())])
PHRASE = "lang string, n int, phrase string, occurrences long"
_PHRASE = pa.schema([("lang", pa.string()), ("n", pa.int32()), ("phrase", pa.string()), ("occurrences", pa.int64())])


def _word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and lengths of the words, and for each whether a break lies between it and the next."""
    gap = np.concatenate([[True], _GAPS[data], [True]])
    edge = np.flatnonzero(gap[1:] != gap[:-1])
    starts, ends = edge[::2], edge[1::2]
    piece = np.cumsum(_BREAKS[data])[starts] if len(starts) else starts
    return starts, ends - starts, np.append(piece[1:] != piece[:-1], True)[: len(starts)]


def _lower(text: str) -> np.ndarray:
    data = np.frombuffer(text.encode(), dtype=np.uint8).copy()
    data[(data >= 65) & (data <= 90)] += 32
    return data


def _word_codes(hashes: np.ndarray, data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A code for each word and the first word of each code; equal hashes are checked against the bytes."""
    starts = np.cumsum(lengths) - lengths
    _, first, codes = np.unique(hashes, return_index=True, return_inverse=True)
    of = first[codes]
    same = bool((lengths[of] == lengths).all())
    for at in range(0, len(starts) if same else 0, 100_000):
        part = slice(at, at + 100_000)
        moved = np.repeat(starts[of[part]] - starts[part], lengths[part])
        here = np.arange(starts[at], starts[at] + len(moved))
        same = same and bool((data[here + moved] == data[here]).all())
    if same:
        return codes, first
    raw, known = data.tobytes(), {}
    codes = np.array([known.setdefault(raw[s : s + n], len(known)) for s, n in zip(starts.tolist(), lengths.tolist(), strict=True)])
    return codes, np.unique(codes, return_index=True)[1]


def make_block(number: int, docs: list[tuple[str, str]]) -> dict:
    """Texts as ``(lang, text)``: codes of their words with -1 behind each piece, one run of codes a language."""
    docs = sorted(docs, key=lambda d: d[0])
    runs: list[list] = []
    data, lengths, breaks, hashes = [], [], [], []

    def add(joined: str) -> int:
        raw = _lower(joined)
        starts, n, after = _word_spans(raw)
        if len(starts):
            solid = raw[~_GAPS[raw]]
            data.append(solid)
            lengths.append(n)
            breaks.append(after)
            hashes.append(hash_pieces(solid, np.cumsum(n) - n)[0])
        return len(starts)

    at = 0
    while at < len(docs):
        lang, held, size = docs[at][0], [], 0
        while at < len(docs) and docs[at][0] == lang and size < HASH_BYTES:
            held.append(docs[at][1])
            size += len(docs[at][1])
            at += 1
        n = add("\n".join(held))
        if runs and runs[-1][0] == lang:
            runs[-1][1] += n
        else:
            runs.append([lang, n])
    langs = [r[0] for r in runs]
    if not data:
        return {"block": number, "codes": b"", "size": 0, "words": b"", "langs": langs, "ends": [0] * len(runs), "n_words": [0] * len(runs)}
    solid, n, after = np.concatenate(data), np.concatenate(lengths), np.concatenate(breaks)
    codes, first = _word_codes(np.concatenate(hashes), solid, n)
    starts, raw = np.cumsum(n) - n, solid.tobytes()
    words = b" ".join(raw[s : s + k] for s, k in zip(starts[first].tolist(), n[first].tolist(), strict=True))
    to = np.arange(len(codes)) + np.cumsum(after) - after
    out = np.full(len(codes) + int(after.sum()), -1, dtype="<i4")
    out[to] = codes
    upto = np.cumsum([r[1] for r in runs])
    ends = [int(to[u - 1]) + 2 if u else 0 for u in upto]
    packed = pa.compress(out.tobytes(), codec="zstd", asbytes=True)
    return {"block": number, "codes": packed, "size": len(out), "words": words, "langs": langs, "ends": ends, "n_words": [r[1] for r in runs]}


def _cut(text: str) -> Iterator[str]:
    """A text longer than a block in parts that end at a break, where no phrase crosses."""
    at = 0
    while len(text) - at > BLOCK_BYTES:
        end = max(text.rfind(c, at, at + BLOCK_BYTES) for c in "\n.,;:!?")
        if end < 0:
            found = [x for x in (text.find(c, at + BLOCK_BYTES) for c in "\n.,;:!?") if x >= 0]
            end = min(found, default=len(text) - 1)
        yield text[at : end + 1]
        at = end + 1
    yield text[at:]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    number, held, size = TaskContext.get().partitionId() << 32, [], 0
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            for part in _cut(text or ""):
                held.append((NO_LANG if lang is None else lang, part))
                size += len(part)
                if size >= BLOCK_BYTES:
                    yield pa.RecordBatch.from_pylist([make_block(number, held)], schema=_BLOCK)
                    number, held, size = number + 1, [], 0
    if held:
        yield pa.RecordBatch.from_pylist([make_block(number, held)], schema=_BLOCK)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse."""
    out = []
    for b in (_BASE, pow(_BASE, -1, 1 << 64)):
        p = np.full(n, b, dtype=np.uint64)
        p[:1] = 1
        out.append(np.cumprod(p))
    return out[0], out[1]


class Block:
    """A block as a task reads it, with the fingerprints of its n-grams."""

    def __init__(self, row: dict):
        raw = pa.decompress(row["codes"], decompressed_size=4 * row["size"], codec="zstd", asbytes=True) if row["size"] else b""
        self.codes = np.frombuffer(raw, dtype="<i4")
        self.words = row["words"].split(b" ")
        starts = [0, *row["ends"]]
        runs = [(lang, b - a) for lang, a, b in zip(row["langs"], starts, starts[1:], strict=False) if b > a]
        self.langs = [lang for lang, _ in runs]
        self.run_of = np.repeat(np.arange(len(runs)), [n for _, n in runs])
        lengths = np.array([len(w) for w in self.words], dtype=np.int64)
        hashes = hash_pieces(np.frombuffer(b"".join(self.words), dtype=np.uint8), np.cumsum(lengths) - lengths)[0]
        # Prefix polynomials over the word hashes; a break counts as 0.
        power, self.back = _powers(len(self.codes))
        self.sums = np.zeros(len(self.codes) + 1, dtype=np.uint64)
        np.cumsum(np.where(self.codes >= 0, hashes[self.codes], np.uint64(0)) * power, out=self.sums[1:])

    def fingerprints(self, places: np.ndarray, n: int) -> np.ndarray:
        seeds = np.array([xxhash.xxh64_intdigest(f"{n}:{lang}") for lang in self.langs], dtype=np.uint64)
        h = (self.sums[places + n] - self.sums[places]) * self.back[places]
        h = (h ^ (h >> np.uint64(31))) + seeds[self.run_of[places]]
        h *= _MIX
        return h ^ (h >> np.uint64(33))

    def grams(self, level: int, good: np.ndarray | None, longest: int) -> list[tuple[int, np.ndarray]]:
        """Length and places of a level's n-grams: words, pairs of frequent words, or longer ones made of frequent pairs."""
        if level == 1:
            return [(1, np.flatnonzero(self.codes >= 0))]
        if level == 2:
            return [(2, np.flatnonzero(good[:-1] & good[1:]))]
        run, out = good, []
        for n in range(3, longest + 1):
            run = run[:-1] & good[n - 2 :]
            out.append((n, np.flatnonzero(run)))
        return out

    def keys(self, grams: list[tuple[int, np.ndarray]], slice_bits: int) -> np.ndarray:
        """The leading bits of the fingerprints: those of the slice and 32 more."""
        found = [self.fingerprints(places, n) for n, places in grams]
        return np.concatenate(found) >> np.uint64(32 - slice_bits)

    def frequent(self, level: int, bits: list[dict], slice_bits: int, longest: int) -> tuple[list[tuple[int, np.ndarray]], np.ndarray]:
        """The n-grams of the level whose fingerprints are frequent, by the bits that came back for levels up to it."""
        good, kept = None, []
        for at in range(1, level + 1):
            grams = self.grams(at, good, longest)
            keys, inverse = np.unique(self.keys(grams, slice_bits), return_inverse=True)
            flags = self.flags(keys, [b for b in bits if b["level"] == at])[inverse]
            kept, start = [], 0
            for n, places in grams:
                kept.append((n, places[flags[start : start + len(places)]]))
                start += len(places)
            good = np.zeros(len(self.codes), dtype=bool)
            good[kept[0][1]] = True
        return kept, good

    @staticmethod
    def flags(keys: np.ndarray, bits: list[dict]) -> np.ndarray:
        """The bits of all slices in order, one a key."""
        slices, counts = np.unique(keys >> np.uint64(32), return_counts=True)
        of = {b["slice"]: b["bits"] for b in bits}
        parts = [np.unpackbits(np.frombuffer(of[s], dtype=np.uint8), count=c) for s, c in zip(slices.tolist(), counts.tolist(), strict=True)]
        return np.concatenate(parts).astype(bool) if parts else np.zeros(0, dtype=bool)


def distinct(fingerprints: np.ndarray, places: np.ndarray, codes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fingerprint, first place and count of the n-grams at ``places``; equal fingerprints are checked word by word."""
    found, first, inverse, counts = np.unique(fingerprints, return_index=True, return_inverse=True, return_counts=True)
    if all((codes[places + k] == codes[places[first[inverse]] + k]).all() for k in range(n)):
        return found, places[first], counts
    grams = np.stack([codes[places + k] for k in range(n)], axis=1)
    _, first, counts = np.unique(grams, axis=0, return_index=True, return_counts=True)
    return fingerprints[first], places[first], counts


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch.slice(k, 1).to_pylist()[0]


def _runs(level: int, longest: int, slice_bits: int):
    """A block's fingerprints of a level as sorted runs, one a slice, with counts of at most 255."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            if not row["size"]:
                continue
            block = Block(row)
            good = block.frequent(level - 1, row["bits"], slice_bits, longest)[1] if level > 1 else None
            keys, counts = np.unique(block.keys(block.grams(level, good, longest), slice_bits), return_counts=True)
            slices, starts = np.unique(keys >> np.uint64(32), return_index=True)
            low, few = keys.astype("<u4"), np.minimum(counts, 255).astype(np.uint8)
            bounds = [*starts.tolist(), len(keys)]
            parts = list(zip(bounds, bounds[1:], strict=False))
            columns = [slices.astype(np.int32), np.full(len(parts), row["block"]), [low[a:b].tobytes() for a, b in parts], [few[a:b].tobytes() for a, b in parts]]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _RUN, strict=True)], schema=_RUN)

    return task


def _sums(least: int):
    """For each run of a slice, a bit an entry: whether its fingerprint reaches the threshold over all blocks."""
    if least > 255:
        raise ValueError("counts of a run end at 255")

    def bits(number: int, runs: list[dict]) -> pa.RecordBatch:
        keys = np.concatenate([np.frombuffer(r["keys"], dtype="<u4") for r in runs])
        counts = np.concatenate([np.frombuffer(r["counts"], dtype=np.uint8) for r in runs])
        order = np.argsort(keys)
        ordered = keys[order]
        first = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
        enough = ordered[first[np.add.reduceat(counts[order].astype(np.int64), first) >= least]]
        flags, ends = np.isin(keys, enough), np.cumsum([len(r["counts"]) for r in runs])
        packed = [np.packbits(flags[e - len(r["counts"]) : e]).tobytes() for r, e in zip(runs, ends.tolist(), strict=True)]
        return pa.RecordBatch.from_arrays([pa.array([r["block"] for r in runs]), pa.array([number] * len(runs), pa.int32()), pa.array(packed, pa.binary())], schema=_BITS)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if held and held[0]["slice"] != row["slice"]:
                    yield bits(held[0]["slice"], held)
                    held = []
                held.append(row)
        if held:
            yield bits(held[0]["slice"], held)

    return task


def _texts(levels: int, longest: int, slice_bits: int):
    """The n-grams of a block behind frequent fingerprints, checked word by word, as text with their counts."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            block = Block(row)
            for level in range(1, levels + 1):
                for n, places in block.frequent(level, row["bits"], slice_bits, longest)[0]:
                    if not len(places):
                        continue
                    _, first, counts = distinct(block.fingerprints(places, n), places, block.codes, n)
                    for at in range(0, len(first), BATCH_ROWS):
                        some = first[at : at + BATCH_ROWS]
                        words = [[block.words[c] for c in block.codes[some + k].tolist()] for k in range(n)]
                        phrases = [b" ".join(w).decode() for w in zip(*words, strict=True)]
                        langs = [block.langs[r] for r in block.run_of[some].tolist()]
                        columns = [langs, np.full(len(some), n, np.int32), phrases, counts[at : at + BATCH_ROWS].astype(np.int64)]
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _PHRASE, strict=True)], schema=_PHRASE)

    return task


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """Phrases of up to ``longest`` words found ``least`` times or more, and the number of words by language.

    The first frame has ``lang, n, phrase, occurrences``, the second ``lang, words``. From ``lang, text``; other columns
    are left out, whatever their names. A null text is empty, a null language is ``und`` (and one with it). Every row
    counts, repeated ones as well. Empty table: no rows. Phrases stay within pieces between breaks.

    A task holds one block, or one slice of the fingerprints, at a time; a text longer than a block is cut at a break
    into several. A word that holds a third of all places has one entry a block in the shuffle. Nothing is broadcast but
    by the planner's own size check of a written table.
    """
    blocks = materialise(docs.select("lang", "text").mapInArrow(_blocks, BLOCK), "blocks")
    slice_bits = (max(SLICES, blocks.count()) - 1).bit_length()
    levels = min(longest, 3)
    columns = ("block", "codes", "size", "words", "langs", "ends")
    known, bits = blocks.select(*columns), None
    for level in range(1, levels + 1):
        runs = known.mapInArrow(_runs(level, longest, slice_bits), RUN)
        dealt = runs.repartition("slice").sortWithinPartitions("slice")
        found = materialise(dealt.mapInArrow(_sums(least), BITS).withColumn("level", F.lit(level)), "bits")
        bits = found if bits is None else bits.unionByName(found)
        back = materialise(bits.groupBy("block").agg(F.collect_list(F.struct("level", "slice", "bits")).alias("bits")), "known")
        known = blocks.join(back, "block").select(*columns, "bits")
    texts = known.mapInArrow(_texts(levels, longest, slice_bits), PHRASE)
    phrases = texts.groupBy("lang", "n", "phrase").agg(F.sum("occurrences").alias("occurrences")).where(F.col("occurrences") >= least)
    words = blocks.select(F.explode(F.arrays_zip("langs", "n_words")).alias("x")).groupBy(F.col("x.langs").alias("lang"))
    return materialise(phrases, "phrases"), words.agg(F.sum("x.n_words").alias("words"))


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, best: int = BEST, covered: int = COVERED) -> DataFrame:
    """The ``best`` collocations of each language: ``lang, rank, phrase, a, l, r, n, score``.

    ``a`` counts the phrase, ``l`` and ``r`` the parts of its lowest-scoring cut (ties: the earliest), ``n`` the
    language's words; ``score`` is ``2000000 * a / (l + r)`` rounded down. Phrases inside a longer candidate with
    at least ``covered`` hundredths of their occurrences go. See ``frequent_phrases`` for nulls, ties and empty tables;
    equal scores go by ``a``, then by the phrase's bytes. Both parts of a candidate are at least as frequent as it is, so
    they are among the frequent phrases.
    """
    phrases, words = frequent_phrases(docs, least, longest)
    parts = F.split("phrase", " ", -1)
    candidates = phrases.where("n >= 2").select("lang", "n", "phrase", F.col("occurrences").alias("a"), parts.alias("w"))
    inside = F.expr("flatten(transform(sequence(2, n - 1), m -> transform(sequence(1, n - m + 1), s -> array_join(slice(w, s, m), ' '))))")
    longer = candidates.where("n >= 3").select("lang", "a", F.explode(inside).alias("phrase"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("a").alias("around"))
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    kept = candidates.join(longer, ["lang", "phrase"], "left")
    kept = kept.where(F.col("around").isNull() | (wide("around") * F.lit(100).cast("decimal(3,0)") < wide("a") * F.lit(covered).cast("decimal(3,0)")))
    cut = kept.select("lang", "phrase", "a", "n", "w", F.explode(F.sequence(F.lit(1), F.col("n") - 1)).alias("k"))
    cut = cut.select("lang", "phrase", "a", "k", F.expr("array_join(slice(w, 1, k), ' ')").alias("first"), F.expr("array_join(slice(w, k + 1, n - k), ' ')").alias("last"))
    count_of = lambda part, name: phrases.select("lang", F.col("phrase").alias(part), F.col("occurrences").alias(name))
    cut = cut.join(count_of("first", "l"), ["lang", "first"]).join(count_of("last", "r"), ["lang", "last"])
    score = F.expr(f"CAST(CAST({SCORE_SCALE} AS DECIMAL(7,0)) * CAST(a AS DECIMAL(20,0)) div (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0))) AS BIGINT)")
    worst = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    scored = cut.groupBy("lang", "phrase", "a").agg(worst).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    return ranked.join(words.withColumnRenamed("words", "n"), "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
