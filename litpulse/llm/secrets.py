"""Secrets by base patterns and by a linear-chain conditional random field.

A text is a sequence of tokens: runs of letters, runs of digits, single symbols. Each is tagged
as beginning, inside or outside a secret. A tag's score comes from the token's shape, from
the tokens two places to either side, from the run of letters and digits it stands in,
and from features of the whole text; neighbouring tags score as pairs. Tags are decoded by
Viterbi. Where a token's score for *outside* exceeds the others by more than all pair
scores can make up, every best path is outside there, so only the stretches between
such tokens are decoded; the result is that of the whole text.

The field is fitted by gradient on the conditional likelihood, on windows of a bounded sample
of documents whose tags come from the base patterns.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Documents of the fitting sample, taken by a hash of their id, and windows without a secret per document.
SAMPLE_DOCUMENTS = 12_000
NEGATIVE_SHARE = 8
WINDOW_TOKENS = 8
#: For fitting: tokens of one secret and windows of one document at most, and windows of one padded block.
SECRET_TOKENS = 128
DOCUMENT_WINDOWS = 8
BLOCK_WINDOWS = 1024
ROUNDS, RATE, SHRINK = 80, 0.3, 1e-3

KINDS = ("assign", "access", "hex", "crf")
# The base patterns, the group that is the secret, and its least length. Letters meet their other case as in
# Unicode, which gives s, k and i further ones: U+017F, U+212A, U+0130 and U+0131.
BASE = (
    (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I), 2, 6),
    (re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    (re.compile(r"[0-9a-f]+"), 0, 24),
)
# Equal to the first two where they can match, and quick where they cannot.
HEX_RUN = re.compile(r"[0-9a-f]{24,}")
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api")

TOKEN = re.compile(r"\s?(?:[^\W\d_]+|\d+|[^\w\s]|_)")
KEYWORDS = ("password", "passwd", "pwd", "secret", "token", "api", "key", "apikey", "auth", "bearer", "credential")
LANGUAGES = ("en", "fr", "de", "es")

OUT, BEGIN, INSIDE = 0, 1, 2
N_KIND, N_LENGTH, N_WORD = 9, 6, len(KEYWORDS) + 1
N_CLASS = N_KIND * N_LENGTH * 2 * 2 * N_WORD
PAD = N_CLASS
OFFSETS = (-2, -1, 0, 1, 2)
N_RUN = 8 * 2 * 4
N_FILE = len(LANGUAGES) + 1 + 4 + 2


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the base patterns, in code points, sorted."""
    found = []
    lower = text.lower().replace("\u017f", "s").replace("\u0131", "i")
    for kind, (pattern, group, least) in enumerate(BASE):
        if kind == 0 and not any(w in lower for w in ASSIGN_WORDS) or kind == 1 and "AKIA" not in text:
            continue
        for m in (HEX_RUN if kind == 2 else pattern).finditer(text):
            if m.end(group) - m.start(group) >= least:
                found.append((m.start(group), kind, m.end(group)))
    return sorted(found)


def token_class(token: str) -> int:
    """Shape of a token and whether it adjoins the one before, as one number."""
    glued = not token[0].isspace()
    word = token if glued else token[1:]
    first, n, keyword = word[0], len(word), 0
    if first.isdigit():
        kind, hexish = 4, True
    elif first.isalpha():
        lower = word.lower()
        kind = 0 if word == lower else 2 if word == word.upper() else 1 if word[1:] == lower[1:] else 3
        hexish = not word.strip("abcdef")
        keyword = KEYWORDS.index(lower) + 1 if lower in KEYWORDS else 0
    else:
        kind, hexish = 5 if first in "=:" else 6 if first in "\"'" else 7 if first in "_-./+" else 8, False
    length = 0 if n == 1 else 1 if n == 2 else 2 if n <= 4 else 3 if n <= 8 else 4 if n <= 15 else 5
    return (((kind * N_LENGTH + length) * 2 + hexish) * 2 + glued) * N_WORD + keyword


class _Classes(dict):
    """Class and length of tokens seen, packed; started anew when large, which bounds memory only."""

    def __missing__(self, token: str) -> int:
        if len(self) > 500_000:
            self.clear()
        found = self[token] = token_class(token) | (len(token) - token[0].isspace()) << 20
        return found


CLASSES = _Classes()


def _phi() -> np.ndarray:
    """Which shape features each class has."""
    code = np.arange(N_CLASS)
    code, keyword = np.divmod(code, N_WORD)
    code, glued = np.divmod(code, 2)
    code, hexish = np.divmod(code, 2)
    kind, length = np.divmod(code, N_LENGTH)
    groups = (kind, kind * N_LENGTH + length, hexish * N_LENGTH + length, kind * 2 + glued, keyword)
    blocks = []
    for g in groups:
        one = np.zeros((N_CLASS + 1, int(g.max()) + 1))
        one[np.arange(N_CLASS), g] = 1
        blocks.append(one)
    return np.concatenate(blocks, axis=1)


PHI = _phi()


class Model(NamedTuple):
    """Score tables: per offset and class, per run, per feature of the file, and per pair of tags."""

    shapes: np.ndarray
    runs: np.ndarray
    files: np.ndarray
    pairs: np.ndarray


def run_classes(c: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The run of adjoining letters and digits each token stands in: length, mixture, number of tokens."""
    kind = np.minimum(c // (N_LENGTH * 4 * N_WORD), N_KIND)
    glued = (c // N_WORD) % 2 == 1
    alnum = kind <= 4
    joins = np.zeros(len(c), dtype=bool)
    joins[1:] = glued[1:] & alnum[1:] & alnum[:-1] & (c[1:] != PAD) & (c[:-1] != PAD)
    run = np.cumsum(~joins) - 1
    chars, digits, tokens = np.bincount(run, lengths), np.bincount(run, kind == 4), np.bincount(run)
    mixed = (digits > 0) & (digits < tokens)
    size = np.searchsorted([3, 7, 11, 15, 19, 23, 31], chars, side="left")
    number = np.searchsorted([1, 2, 5], tokens, side="left")
    return ((size * 2 + mixed) * 4 + number)[run]


def file_features(lang: str | None, c: np.ndarray) -> list[int]:
    """Language, share of digit runs, and whether the text holds a keyword."""
    language = LANGUAGES.index(lang) if lang in LANGUAGES else len(LANGUAGES)
    share = float((c // (N_LENGTH * 4 * N_WORD) == 4).mean()) if len(c) else 0.0
    density = 0 if share == 0 else 1 if share < 0.01 else 2 if share < 0.05 else 3
    return [language, len(LANGUAGES) + 1 + density, len(LANGUAGES) + 5 + bool((c % N_WORD > 0).any())]


def emissions(model: Model, c: np.ndarray, runs: np.ndarray, files: np.ndarray) -> np.ndarray:
    """Scores per token and tag; ``c`` starts and ends with two pads."""
    e = model.runs[runs] + files
    for k, offset in enumerate(OFFSETS):
        at = model.shapes[k]
        if offset < 0:
            e[-offset:] += at[c[:offset]]
        elif offset > 0:
            e[:-offset] += at[c[offset:]]
        else:
            e += at[c]
    e[c == PAD] = (1e6, 0.0, 0.0)
    return e


def viterbi(e: np.ndarray, pairs: np.ndarray, before: bool, after: bool) -> list[int]:
    """The best tags of a stretch; *outside* stands before and after it where there is a neighbour."""
    score, back = e[0] + (pairs[OUT] if before else 0), []
    for row in e[1:]:
        step = score[:, None] + pairs
        back.append(step.argmax(axis=0))
        score = step.max(axis=0) + row
    if after:
        score = score + pairs[:, OUT]
    tags = [int(score.argmax())]
    for choice in reversed(back):
        tags.append(int(choice[tags[-1]]))
    return tags[::-1]


def decode(e: np.ndarray, pairs: np.ndarray) -> dict[int, int]:
    """Places whose best tag is not *outside*."""
    # The most that pair scores around one token can gain over passing it as outside, at an end or between two others.
    into, out_of = pairs[:, 1:] - pairs[:, [OUT]], pairs[1:] - pairs[OUT]
    gain = max(into.max(), out_of.max(), max((into[:, [y]] + out_of[[y]]).max() for y in range(2)), 0.0)
    open_ = np.flatnonzero(e[:, OUT] - e[:, BEGIN:].max(axis=1) <= gain + 1e-9)
    found: dict[int, int] = {}
    if not len(open_):
        return found
    for stretch in np.split(open_, np.flatnonzero(np.diff(open_) > 1) + 1):
        a, b = int(stretch[0]), int(stretch[-1]) + 1
        for k, tag in enumerate(viterbi(e[a:b], pairs, a > 0, b < len(e)), a):
            if tag:
                found[k] = tag
    return found


def _tokens(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Classes and lengths of a text's tokens."""
    tokens = TOKEN.findall(text)
    packed = np.fromiter(map(CLASSES.__getitem__, tokens), dtype=np.int64, count=len(tokens))
    return packed & 0xFFFFF, packed >> 20


def crf_spans(model: Model, texts: list[str], langs: list[str | None]) -> list[list[tuple[int, int]]]:
    """Spans tagged by the field in each text."""
    pad, none = np.array([PAD, PAD]), np.zeros(2, dtype=np.int64)
    parts, lengths, files, firsts, at = [pad], [none], [np.zeros((2, 3))], [], 2
    for text, lang in zip(texts, langs, strict=True):
        c, sizes = _tokens(text)
        firsts.append(at)
        at += len(c) + 2
        parts += [c, pad]
        lengths += [sizes, none]
        score = model.files[file_features(lang, c)].sum(axis=0)
        files += [np.broadcast_to(score, (len(c), 3)), np.zeros((2, 3))]
    c = np.concatenate(parts)
    e = emissions(model, c, run_classes(c, np.concatenate(lengths)), np.concatenate(files))
    tags = decode(e, model.pairs)
    out: list[list[tuple[int, int]]] = [[] for _ in texts]
    by_text: dict[int, list[int]] = {}
    for place in sorted(tags):
        by_text.setdefault(int(np.searchsorted(firsts, place, side="right")) - 1, []).append(place)
    for k, places in by_text.items():
        where = [(m.start() + m.group()[0].isspace(), m.end()) for m in TOKEN.finditer(texts[k])]
        for place in places:
            start, end = where[place - firsts[k]]
            if out[k] and tags[place] == INSIDE and out[k][-1][1] == start and place - 1 in tags:
                out[k][-1] = (out[k][-1][0], end)
            else:
                out[k].append((start, end))
    return out


def training_windows(text: str, lang: str | None, draw: int) -> list[dict]:
    """Windows of tokens with tags from the base patterns; some texts without a secret give one, by the draw.

    A text gives ``DOCUMENT_WINDOWS`` at most, spread over its secrets, and a window holds ``SECRET_TOKENS`` of
    a secret at most and ``WINDOW_TOKENS`` on either side. Only fitting is bounded; decoding sees whole texts.
    """
    spans = base_spans(text)
    if not spans and draw % NEGATIVE_SHARE:
        return []
    c, sizes = _tokens(text)
    if not len(c):
        return []
    where = [(m.start() + m.group()[0].isspace(), m.end()) for m in TOKEN.finditer(text)] if spans else []
    tags = np.zeros(len(c), dtype=np.int64)
    starts, ends = (np.array([w[k] for w in where]) for k in (0, 1))
    covered = 0
    for start, _, end in spans:
        first, last = np.searchsorted(starts, start), np.searchsorted(ends, end, "right")
        # Spans ascend, so one meets an earlier one if it begins before the last end.
        if first < last and start >= covered:
            covered = end
            tags[first:last] = INSIDE
            tags[first] = BEGIN
    runs = run_classes(np.concatenate([[PAD], c]), np.concatenate([[0], sizes]))[1:]
    files = file_features(lang, c)
    hits = np.flatnonzero(tags == BEGIN)
    if not spans:
        hits = np.array([draw // NEGATIVE_SHARE % len(c)])
    elif len(hits) > DOCUMENT_WINDOWS:
        hits = hits[np.arange(DOCUMENT_WINDOWS) * len(hits) // DOCUMENT_WINDOWS]
    out = []
    for hit in hits:
        a, b = max(0, hit - WINDOW_TOKENS), hit + 1
        while b < len(c) and tags[b] == INSIDE and b - hit < SECRET_TOKENS:
            b += 1
        # A window that holds a secret in part ends inside it.
        b = b if b < len(c) and tags[b] == INSIDE else min(len(c), b + WINDOW_TOKENS)
        around = [int(c[k]) if 0 <= k < len(c) else PAD for k in range(a - 2, b + 2)]
        out.append({"classes": around, "runs": runs[a:b].tolist(), "files": files, "tags": tags[a:b].tolist()})
    return out


class _Block:
    """Windows padded to the longest among them, out of ``total``."""

    def __init__(self, windows: list[dict], total: int) -> None:
        n, most = len(windows), max(len(w["tags"]) for w in windows)
        self.total, self.c = total, np.full((n, most + 4), PAD)
        self.runs, self.tags, self.mask = np.zeros((n, most), int), np.zeros((n, most), np.int8), np.zeros((n, most))
        self.files = np.array([w["files"] for w in windows])
        for k, w in enumerate(windows):
            m = len(w["tags"])
            self.c[k, : m + 4], self.runs[k, :m], self.tags[k, :m], self.mask[k, :m] = w["classes"], w["runs"], w["tags"], 1

    def slope(self, theta: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        """The windows' part in the slope of the mean conditional log-likelihood."""
        c, runs, tags, mask, files = self.c, self.runs, self.tags, self.mask, self.files
        n, most = mask.shape
        real, one_hot = mask > 0, np.eye(3)[tags] * mask[..., None]
        both = mask[:, 1:] * mask[:, :-1]
        seen_pairs = np.einsum("nti,ntj,nt->ij", np.eye(3)[tags[:, :-1]], np.eye(3)[tags[:, 1:]], both)

        def counted(places: np.ndarray, weights: np.ndarray, size: int) -> np.ndarray:
            flat = np.broadcast_to(places, weights.shape[:-1]).ravel()
            return np.stack([np.bincount(flat, weights[..., y].ravel(), size) for y in range(3)], axis=1)

        tables = PHI @ theta["shapes"]
        e = theta["runs"][runs] + theta["files"][files].sum(axis=1)[:, None, :]
        for k, offset in enumerate(OFFSETS):
            e += tables[k][c[:, 2 + offset : 2 + offset + most]]
        # Forward and backward sums, scaled to one at every token.
        own = np.exp(e - e.max(axis=2, keepdims=True))
        step = np.exp(theta["pairs"] - theta["pairs"].max())
        forward, backward = np.ones((most, n, 3)), np.ones((most, n, 3))
        forward[0] = own[:, 0] / own[:, 0].sum(axis=1, keepdims=True)
        for t in range(1, most):
            now = (forward[t - 1] @ step) * own[:, t]
            forward[t] = np.where(real[:, t, None], now / now.sum(axis=1, keepdims=True), forward[t - 1])
        for t in range(most - 2, -1, -1):
            now = (own[:, t + 1] * backward[t + 1]) @ step.T
            backward[t] = np.where(real[:, t + 1, None], now / now.sum(axis=1, keepdims=True), 1.0)
        marginal = (forward * backward).transpose(1, 0, 2)
        marginal *= mask[..., None] / marginal.sum(axis=2, keepdims=True)
        gap = (one_hot - marginal) / self.total
        left, right = forward[:-1].transpose(1, 0, 2), (own[:, 1:] * backward[1:].transpose(1, 0, 2))
        norm = ((left @ step) * right).sum(axis=2)
        expected = step * np.einsum("nti,ntj->ij", left * (both / norm)[..., None], right)
        return {
            "shapes": np.stack([PHI.T @ counted(c[:, 2 + o : 2 + o + most], gap, N_CLASS + 1) for o in OFFSETS]),
            "runs": counted(runs, gap, N_RUN),
            "files": sum(counted(files[:, k], gap.sum(axis=1), N_FILE) for k in range(files.shape[1])),
            "pairs": (seen_pairs - expected) / self.total,
        }


def fit(windows: list[dict], rounds: int = ROUNDS, rate: float = RATE, shrink: float = SHRINK) -> Model:
    """Weights by adaptive gradient ascent on the mean conditional log-likelihood; no windows: everything is outside."""
    n_off = len(OFFSETS)
    theta = {"shapes": np.zeros((n_off, PHI.shape[1], 3)), "runs": np.zeros((N_RUN, 3)), "files": np.zeros((N_FILE, 3)), "pairs": np.zeros((3, 3))}
    theta["files"][: len(LANGUAGES) + 1, OUT] = 1.0
    if not windows:
        return Model(PHI @ theta["shapes"], theta["runs"], theta["files"] + [[5.0, 0.0, 0.0]], theta["pairs"])
    # Blocks of windows of about one length: padding and memory do not follow the longest window.
    windows = sorted(windows, key=lambda w: len(w["tags"]))
    blocks = [_Block(windows[k : k + BLOCK_WINDOWS], len(windows)) for k in range(0, len(windows), BLOCK_WINDOWS)]
    power = {k: np.full_like(v, 1e-8) for k, v in theta.items()}
    for _ in range(rounds):
        slope = {k: -shrink * v for k, v in theta.items()}
        for block in blocks:
            for k, g in block.slope(theta).items():
                slope[k] += g
        for k, g in slope.items():
            power[k] += g * g
            theta[k] += rate * g / np.sqrt(power[k])
    return Model(PHI @ theta["shapes"], theta["runs"], theta["files"], theta["pairs"])


def fit_on_sample(docs: DataFrame, sample_documents: int = SAMPLE_DOCUMENTS) -> Model:
    """The field of a sample of about ``sample_documents`` of ``doc_id, text, lang``, chosen by hash.

    Windows are cut in the tasks; only those of the sample, of bounded number and length each document,
    come to the driver. They are sorted, so that the result does not depend on arrival.
    """
    n = docs.count()
    share = 1_000_000 if n <= sample_documents else int(1_000_000 * sample_documents / n)
    draw = F.xxhash64(F.lit("crf"), F.coalesce(F.col("doc_id").cast("string"), F.col("text"), F.lit("")))
    sample = docs.where(F.pmod(draw, F.lit(1_000_000)) < share).select("text", "lang", F.pmod(F.shiftright(draw, 20), F.lit(1 << 30)).alias("draw"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(x, pa.list_(pa.int64())) for x in ("classes", "runs", "files", "tags")])
        for batch in batches:
            rows = [w for t, lang, d in zip(*(x.to_pylist() for x in batch.columns), strict=True) for w in training_windows(t or "", lang, d)]
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    rows = sample.mapInArrow(cut, "classes array<long>, runs array<long>, files array<long>, tags array<long>").collect()
    return fit(sorted((r.asDict() for r in rows), key=lambda w: (w["classes"], w["runs"], w["files"], w["tags"])))


def find_secrets(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, spans`` for every row of ``doc_id, text, lang``; spans are ``(start, end, kind)`` in code points.

    Base spans stay; spans of the field are added where they meet no base span. Sorted by
    start, then kind. Null text is empty, null language is another one. Other columns are left out.
    """
    span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())])
    schema = pa.schema([("doc_id", pa.int64()), ("spans", pa.list_(span))])
    tables = Model(*(np.asarray(x, dtype=np.float64) for x in model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            out = []
            for text, tagged in zip(texts, crf_spans(tables, texts, batch.column("lang").to_pylist()), strict=True):
                base = base_spans(text)
                extra = [(a, 3, b) for a, b in tagged if not any(a < e and s < b for s, _, e in base)]
                out.append([{"start": s, "end": e, "kind": KINDS[k]} for s, k, e in sorted(base + extra)])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, schema.field("spans").type)], schema=schema)

    rows = docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text", "lang")
    return rows.mapInArrow(run, "doc_id long, spans array<struct<start: long, end: long, kind: string>>")


def digest(spans: list[tuple[int, int, int]]) -> str:
    """Hexadecimal digest of the base spans of a text, as the query reports it."""
    return hashlib.sha256(",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans).encode()).hexdigest()
