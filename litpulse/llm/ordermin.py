"""Near duplicates by Order MinHash over five-word k-mers, verified by banded alignment.

A text's k-mers are labelled with their occurrence, so repeats count. Each of several hash
functions takes the two labelled k-mers of least hash and keeps them in text order: two
texts agree in such a sample if they share both k-mers and their order, which makes the
sketch sensitive to edits that move text. Equal samples form a bucket.

A bucket's most central text is its pivot, and every other member is verified against the pivot
alone; groups of copies are thereby connected in linear work. Two members of which one is not
connected to their pivot can still be similar. These, and only these, are compared in blocks: the
unconnected members of a pivot against all its members, a bounded number of texts a side per
task, and nothing but links leaves a task. No link between candidates is lost, and nothing is capped.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litpulse.llm.common import components
from litpulse.session import materialise

#: Words of a k-mer, least similarity, and samples per text: a pair at the threshold misses all with odds of 5 in a million.
WORDS = 5
SIMILARITY = 0.8
SAMPLES = 12
#: Texts a side of a block; it bounds a task's memory and rows.
BLOCK = 192

TOKEN = re.compile(r"\w+")
_MIX = tuple(np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
_STEPS = np.random.default_rng(5).integers(1, 2**63, size=64, dtype=np.uint64) | np.uint64(1)
_SEEDS = np.random.default_rng(7).integers(1, 2**63, size=256, dtype=np.uint64)
_TOP = np.uint64(2**64 - 1)


class _WordHashes(dict):
    """Hashes of words seen; started anew when large, which bounds memory only."""

    def __missing__(self, word: str) -> int:
        if len(self) > 500_000:
            self.clear()
        found = self[word] = int.from_bytes(hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
        return found


_HASHES = _WordHashes()


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def kmers(texts: list[str], words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Occurrence-labelled k-mer hashes of all texts in order, and how many each has.

    Words are runs of letters and digits in lower case. A text of fewer words than a k-mer
    has one k-mer of all its words; a text without words has none.
    """
    found = [TOKEN.findall(t.lower()) for t in texts]
    n_words = np.array([len(f) for f in found], dtype=np.int64)
    total = int(n_words.sum())
    w = np.fromiter((_HASHES[x] for f in found for x in f), dtype=np.uint64, count=total)
    counts = np.where(n_words > 0, np.maximum(n_words - words + 1, 1), 0)
    first_word = np.cumsum(n_words) - n_words
    text_of = np.repeat(np.arange(len(texts)), counts)
    at = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts) + first_word[text_of]
    h = np.zeros(len(at), dtype=np.uint64)
    last = (first_word + n_words)[text_of]
    padded = np.append(w, np.zeros(words, dtype=np.uint64))
    for k in range(words):
        h += np.where(at + k < last, padded[at + k], 0) * _STEPS[k]
    h = mix(h)
    # The occurrence of a k-mer within its text.
    order = np.lexsort((h, text_of))
    sh, st = h[order], text_of[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (sh[1:] != sh[:-1]) | (st[1:] != st[:-1])
    begins = np.flatnonzero(new)
    nth = np.empty(len(h), dtype=np.uint64)
    nth[order] = np.arange(len(h)) - np.repeat(begins, np.diff(np.append(begins, len(h))))
    return np.where(nth > 0, mix(h + nth * _STEPS[63]), h), counts


def order_samples(x: np.ndarray, counts: np.ndarray, samples: int = SAMPLES) -> np.ndarray:
    """One signature per sample and text that has k-mers: its two least k-mers in text order."""
    counts = counts[counts > 0]
    starts = np.cumsum(counts) - counts
    place = np.arange(len(x))
    out = np.empty((samples, len(counts)), dtype=np.uint64)
    none = np.int64(len(x))
    for k in range(samples):
        v = mix(x ^ _SEEDS[k])
        least = []
        for _ in range(2):
            m = np.minimum.reduceat(v, starts)
            at = np.minimum.reduceat(np.where(v == np.repeat(m, counts), place, none), starts)
            least.append((x[at], at))
            v[at] = _TOP
        (a, pa_), (b, pb) = least
        ahead = pa_ <= pb
        first, second = np.where(ahead, a, b), np.where(ahead, b, a)
        out[k] = mix(first * _STEPS[0] + second * _STEPS[1] + np.uint64(k))
    return out


def aligned(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> int:
    """K-mers matched by the best alignment within the band that a similarity of ``least`` allows.

    Bit-parallel longest common subsequence: one bit per k-mer of ``b``, one step per k-mer of
    ``a``; only matches within the band around the diagonal count. Common ends are matched first.
    """
    short = min(len(a), len(b))
    same = a[:short] == b[:short]
    head = short if same.all() else int(np.argmin(same))
    a, b = a[head:], b[head:]
    short = min(len(a), len(b))
    tail = 0
    if short:
        same = a[::-1][:short] == b[::-1][:short]
        tail = short if same.all() else int(np.argmin(same))
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    matched = head + tail
    if not len(a) or not len(b):
        return matched
    # Unmatched k-mers of both sides together, at the similarity looked for.
    band = int((len(a) + len(b) + 2 * matched) * (1 - least) / (1 + least)) + 1
    where: dict[int, int] = {}
    for j, v in enumerate(b.tolist()):
        where[v] = where.get(v, 0) | 1 << j
    full = (1 << len(b)) - 1
    row = full
    for i, v in enumerate(a.tolist()):
        match = where.get(v, 0)
        if match:
            low = i - band
            window = (1 << (i + band + 1)) - 1
            match &= window if low <= 0 else window >> low << low
        step = row & match
        row = ((row + step) | (row - step)) & full
    return matched + len(b) - row.bit_count()


def similarity(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> float:
    """Matched k-mers as a share of all, by the banded alignment: the measure that decides.

    It is exact where it reaches ``least``; below, it may be less than an alignment without a band would give.
    """
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if min(len(a), len(b)) < least * max(len(a), len(b)):
        return 0.0
    matched = aligned(a, b, least)
    return matched / (len(a) + len(b) - matched)


def spanning_links(pairs: list[tuple[int, int]], left: list[np.ndarray], right: list[np.ndarray], roots: tuple[list, list], least: float = SIMILARITY) -> list[tuple[int, int]]:
    """The candidate pairs, verified by alignment, that connect what is not yet connected.

    At most one fewer than the roots met, however many pairs there are; a pair whose ends are connected
    already is not aligned.
    """
    parent: dict = {}

    def find(x):
        while parent.get(x, x) != x:
            parent[x] = parent.get(parent[x], parent[x])
            x = parent[x]
        return x

    out = []
    for i, j in pairs:
        x, y = find(roots[0][i]), find(roots[1][j])
        if x != y and similarity(left[i], right[j], least) >= least:
            parent[x] = y
            out.append((i, j))
    return out


def similar_pairs(left: list[np.ndarray], right: list[np.ndarray], least: float = SIMILARITY) -> np.ndarray:
    """``(i, j)`` of all texts of either side whose k-mer sets are similar: the candidates of the alignment, which is never above that."""
    sizes = [np.array([len(x) for x in side]) for side in (left, right)]
    if not left or not right or not sizes[0].sum() or not sizes[1].sum():
        return np.empty((0, 2), dtype=np.int64)
    flat = [np.concatenate(side) for side in (left, right)]
    shared = np.intersect1d(*flat)
    common = np.zeros((len(left), len(right)), dtype=np.float32)
    for at in range(0, len(shared), 4096):
        part = shared[at : at + 4096]
        marks = []
        for values, size in zip(flat, sizes, strict=True):
            place = np.minimum(np.searchsorted(part, values), len(part) - 1)
            hit = part[place] == values
            m = np.zeros((len(size), len(part)), dtype=np.float32)
            m[np.repeat(np.arange(len(size)), size)[hit], place[hit]] = 1
            marks.append(m)
        common += marks[0] @ marks[1].T
    either = sizes[0][:, None] + sizes[1][None, :] - common
    return np.argwhere((common >= least * either) & (either > 0))


def signatures(texts: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """``key, h``: the buckets of every text of ``h, text``."""
    schema = pa.schema([("key", pa.int64()), ("h", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, counts = kmers(batch.column("text").to_pylist())
            ids = batch.column("h").filter(pa.array(counts > 0))
            if len(ids):
                for row in order_samples(x, counts, samples):
                    yield pa.RecordBatch.from_arrays([pa.array(row.view(np.int64)), ids], schema=schema)

    return texts.select("h", "text").mapInArrow(run, "key long, h string")


def with_pivots(members: DataFrame) -> DataFrame:
    """``a, p``: members of the buckets of ``key, h`` with their pivots, the texts of the largest buckets in sum."""
    sizes = members.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = materialise(members.join(sizes, "key"), "shared")
    central = shared.groupBy("h").agg(F.sum("n").alias("c"))
    ranked = shared.join(central, "h").select("key", "h", "c")
    pivots = ranked.groupBy("key").agg(F.max(F.struct("c", "h")).alias("m")).select("key", F.col("m.h").alias("p"))
    found = shared.join(pivots, "key").where("h != p").select(F.col("h").alias("a"), "p")
    return materialise(found.distinct(), "pairs")


def verify(pairs: DataFrame, texts: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """Pairs ``a, p`` with their similarity by alignment."""
    schema = pa.schema([("a", pa.string()), ("p", pa.string()), ("sim", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, p = batch.column("a").to_pylist(), batch.column("p").to_pylist()
            known: dict[str, np.ndarray] = {}
            for ids, column in ((a, "text_a"), (p, "text_p")):
                new = {i: t for i, t in zip(ids, batch.column(column).to_pylist(), strict=True) if i not in known}
                x, counts = kmers(list(new.values()))
                known.update(zip(new, np.split(x, np.cumsum(counts)[:-1]), strict=True))
            out = [similarity(known[i], known[j], least) for i, j in zip(a, p, strict=True)]
            columns = (a, p, out)
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(columns, schema, strict=True)], schema=schema)

    left = texts.select(F.col("h").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("h").alias("p"), F.col("text").alias("text_p"))
    whole = pairs.join(left, "a").join(right, "p").select("a", "p", "text_a", "text_p")
    return whole.mapInArrow(run, "a string, p string, sim double")


def links_beside_pivots(pairs: DataFrame, roots: DataFrame, texts: DataFrame, least: float = SIMILARITY, block: int = BLOCK) -> DataFrame:
    """Links ``a, b`` that connect members of a pivot which are not connected to it, with as few as do.

    The unconnected members, dealt to blocks by hash, meet all members, dealt to blocks likewise; a
    pair of blocks is one group of a bounded number of texts. A group returns a spanning forest of its links, seeded with
    the roots that are known, so at most as many as it has texts.
    """
    root_of = lambda name: roots.select(F.col("id").alias(name), F.col("root").alias(f"root_{name}"))
    seen = pairs.join(root_of("a"), "a", "left").join(root_of("p"), "p", "left")
    seen = seen.select("a", "p", F.coalesce("root_a", "a").alias("root"), (F.coalesce("root_a", "a") != F.coalesce("root_p", "p")).alias("open"))
    seen = materialise(seen, "members")
    number = lambda c: F.ceil(c / F.lit(block)).cast("bigint")
    groups = seen.groupBy("p").agg(F.count(F.lit(1)).alias("n"), F.count_if("open").alias("m")).where("m > 0 AND n > 1")
    groups = groups.select("p", number(F.col("n")).alias("xs"), number(F.col("m")).alias("ys"))
    each = seen.join(groups, "p")
    deal = lambda n: F.pmod(F.xxhash64("a"), F.col(n))
    every = lambda n: F.explode(F.expr(f"sequence(0L, {n} - 1)"))
    x_side = each.select("p", "a", "root", F.lit(False).alias("asks"), deal("xs").alias("i"), every("ys").alias("j"))
    y_side = each.where("open").select("p", "a", "root", F.lit(True).alias("asks"), every("xs").alias("i"), deal("ys").alias("j"))
    dealt = x_side.unionByName(y_side).join(texts.withColumnRenamed("h", "a"), "a")
    schema = pa.schema([("a", pa.string()), ("b", pa.string())])

    def run(rows: pa.Table) -> pa.Table:
        sides = []
        for asks in (True, False):
            part = rows.filter(pa.compute.equal(rows["asks"], asks))
            x, counts = kmers(part["text"].to_pylist())
            sides.append((part["a"].to_pylist(), part["root"].to_pylist(), np.split(x, np.cumsum(counts)[:-1]) if part.num_rows else []))
        (a, root_a, left), (b, root_b, right) = sides
        met = [(i, j) for i, j in similar_pairs(left, right, least).tolist() if root_a[i] != root_b[j]]
        found = [(a[i], b[j]) for i, j in spanning_links(met, left, right, (root_a, root_b), least)]
        return pa.table([pa.array([f[k] for f in found], pa.string()) for k in range(2)], schema=schema)

    return dealt.groupBy("p", "i", "j").applyInArrow(run, "a string, b string")


def classes(docs: DataFrame, least: float = SIMILARITY, samples: int = SAMPLES) -> DataFrame:
    """``h, doc_id, copies, root``: each different text with its least doc_id, its rows, and its class.

    ``h`` is the text's digest; exact copies are one text from the start. A null text is empty;
    texts without a word are similar only to themselves.
    """
    base = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    base = base.withColumn("h", F.md5(F.col("text").cast("binary")))
    texts = materialise(base.groupBy("h").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies")), "texts")
    buckets = materialise(signatures(base, samples).distinct(), "buckets")
    pairs = with_pivots(buckets)
    # Texts of the pairs, one row each: copies are told apart by their id before they meet.
    involved = pairs.select(F.col("a").alias("h")).union(pairs.select(F.col("p").alias("h"))).distinct()
    wanted = texts.join(involved, "h").select(F.col("h").alias("wanted_h"), F.col("doc_id").alias("wanted_id"))
    whole = base.join(wanted, (base["h"] == wanted["wanted_h"]) & base["doc_id"].eqNullSafe(wanted["wanted_id"]))
    whole = materialise(whole.select("h", "text").dropDuplicates(["h"]), "pair_texts")
    links = materialise(verify(pairs, whole, least).where(F.col("sim") >= least).select("a", F.col("p").alias("b")), "links")
    roots = components(links)
    more = materialise(links_beside_pivots(pairs, roots, whole, least), "links")
    if more.limit(1).count():
        roots = components(links.union(more))
    return texts.join(roots.withColumnRenamed("id", "h"), "h", "left").select("h", "doc_id", "copies", F.coalesce("root", "h").alias("root"))


def near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """One row per document: ``doc_id, class_id, class_size, text_copies``.

    ``class_id`` is the least id of the class, null where the class has none; ``class_size``
    counts its rows. Null ids and repeated rows take part like others. Needs ``doc_id, text``.
    """
    found = materialise(classes(docs, **options), "classes")
    per = found.groupBy("root").agg(F.min("doc_id").alias("class_id"), F.sum("copies").alias("class_size"))
    found = found.join(per, "root").select("h", "class_id", "class_size", F.col("copies").alias("text_copies"))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("h"))
    return rows.join(found, "h").select("doc_id", "class_id", "class_size", "text_copies")


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """The documents without near duplicates: one row of each class, with its own columns.

    The row of the least ``(doc_id, text digest)`` stays, nulls last; of rows that repeat both, one.
    """
    found = materialise(classes(docs, **options), "classes")
    order = lambda i: F.struct(F.col(i).isNull().alias("none"), F.col(i).alias("id"), F.col("h").alias("h"))
    kept = found.groupBy("root").agg(F.min(order("doc_id")).alias("m")).select(F.col("m.id").alias("kept_id"), F.col("m.h").alias("kept_h"))
    own = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    rows = docs.select(own, F.col("doc_id").cast("bigint").alias("doc_id"), F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("h"))
    repeats = rows.groupBy("doc_id", "h").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    kept = kept.join(repeats, kept["kept_h"].eqNullSafe(repeats["h"]) & kept["kept_id"].eqNullSafe(repeats["doc_id"]), "left").select("kept_id", "kept_h", F.coalesce("n", F.lit(1)).alias("n"))
    rows = rows.join(kept, (rows["h"] == kept["kept_h"]) & rows["doc_id"].eqNullSafe(kept["kept_id"])).select("row", "doc_id", "h", "n")
    once = rows.where("n = 1").select("row")
    several = rows.where("n > 1").groupBy("doc_id", "h").agg(F.min_by("row", F.xxhash64("row")).alias("row")).select("row")
    return once.unionByName(several).select("row.*")
