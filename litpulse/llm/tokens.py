"""Token ids of whole texts, and lossless pieces of documents longer than a sequence.

Runs inside Python tasks. Words recur, so under a byte-level BPE a text is cut where
the tokenizer cuts it anyway: before a single space or line break between two other
characters. Pieces seen before come from a dictionary. New ones are merged by the
tokenizer's own ranks in a faster library; a text with any other white space, and every
text under another kind of tokenizer, is encoded whole by ``tokenizers``.
"""

from __future__ import annotations

import json
import os

import numpy as np

#: The pre-tokenizer of byte-level BPE (fixed value).
BYTE_LEVEL = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_level_ranks(spec: dict) -> dict[bytes, int] | None:
    """The vocabulary as bytes, if the file is a plain byte-level BPE whose ids follow its merges."""
    model, cut = spec["model"], spec.get("pre_tokenizer") or {}
    plain = model.get("type") == "BPE" and cut.get("type") == "ByteLevel" and not cut.get("add_prefix_space")
    if not plain or not cut.get("use_regex", True) or spec.get("normalizer") or model.get("dropout"):
        return None
    # Printable Latin-1 bytes stand for themselves, the others for the characters from 256 on.
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    hidden = [b for b in range(256) if b not in set(shown)]
    byte_of = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}
    special = {x["content"] for x in spec.get("added_tokens", [])}
    vocab = {t: i for t, i in model["vocab"].items() if t not in special}
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    ids = [vocab[a + b] for a, b in merges]
    if ids != sorted(ids) or any(c not in byte_of for t in vocab for c in t):
        return None
    return {bytes(byte_of[c] for c in t): i for t, i in vocab.items()}


#: Slots of the dictionary of pieces, and entries it may hold before it is started anew; they bound memory only.
SLOTS = 1 << 21
#: Bytes looked at together, so that the helper arrays stay in the processor's cache.
BLOCK_BYTES = 1 << 20
_KEYS = np.random.default_rng(11).integers(1, 2**63, size=(2, 256), dtype=np.uint64)
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], dtype=np.uint64)


class PieceTable:
    """A dictionary from 128-bit hashes of pieces to their ids, looked up for whole arrays at once."""

    def __init__(self, slots: int = SLOTS):
        self.mask = np.uint64(slots - 1)
        self.most = slots // 2
        self.clear()

    def clear(self) -> None:
        slots = int(self.mask) + 1
        self.key = np.zeros((2, slots), dtype=np.uint64)
        self.first = np.full(slots, -1, dtype=np.int64)
        self.number = np.zeros(slots, dtype=np.int32)
        self.pool = np.empty(1 << 16, dtype="<u4")
        self.used = self.entries = 0

    def find(self, h: np.ndarray) -> np.ndarray:
        """The slot of each hash, -1 where it is missing."""
        out, at = np.full(h.shape[1], -1, dtype=np.int64), (h[0] & self.mask).astype(np.int64)
        open_ = np.arange(h.shape[1])
        while len(open_):
            slot = at[open_]
            taken = self.first[slot] >= 0
            same = taken & (self.key[0, slot] == h[0, open_]) & (self.key[1, slot] == h[1, open_])
            out[open_[same]] = slot[same]
            open_ = open_[taken & ~same]
            at[open_] = (at[open_] + 1) & int(self.mask)
        return out

    def add(self, h: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        """Enter hashes that differ from each other and from those held."""
        while self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.empty_like(self.pool)])
        self.pool[self.used : self.used + len(ids)] = ids
        firsts = self.used + np.concatenate([[0], np.cumsum(counts)[:-1]])
        self.used += len(ids)
        self.entries += h.shape[1]
        at, open_ = (h[0] & self.mask).astype(np.int64), np.arange(h.shape[1])
        while len(open_):
            slot = at[open_]
            free = np.flatnonzero(self.first[slot] < 0)
            _, chosen = np.unique(slot[free], return_index=True)
            put = free[chosen]
            to, who = slot[put], open_[put]
            self.key[:, to], self.first[to], self.number[to] = h[:, who], firsts[who], counts[who]
            open_ = np.delete(open_, put)
            at[open_] = (at[open_] + 1) & int(self.mask)


def hash_pieces(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Two 64-bit hashes of the byte runs that begin at ``starts`` and end at the next."""
    lengths = np.diff(np.append(starts, len(data)))
    place = np.arange(len(data)) - np.repeat(starts, lengths)
    out = np.empty((2, len(starts)), dtype=np.uint64)
    for k in range(2):
        powers = np.full(int(lengths.max()), _ODD[k], dtype=np.uint64)
        powers[0] = 1
        h = np.add.reduceat(_KEYS[k][data] * np.cumprod(powers)[place], starts)
        h ^= h >> np.uint64(29)
        h *= _ODD[1 - k]
        out[k] = h ^ (h >> np.uint64(32))
    return out


def odd_documents(data: np.ndarray, doc_starts: np.ndarray) -> np.ndarray:
    """Which documents hold white space other than single spaces and line breaks between other characters."""
    after = np.append(data[1:], 0)
    cut = (data == 32) | (data == 10)
    first = np.zeros(len(data) + 1, dtype=bool)
    first[doc_starts] = True
    odd = cut & np.append(cut[1:], False) & ~first[1:]
    odd |= ((data >= 9) & (data <= 13) & (data != 10)) | ((data >= 28) & (data <= 31))
    for at in np.flatnonzero((data == 0xC2) | ((data >= 0xE1) & (data <= 0xE3))):
        if data[at] == 0xC2:
            odd[at] = after[at] in (0x85, 0xA0)
        else:
            odd[at] = chr_at(data, at).isspace()
    hit = np.flatnonzero(odd)
    out = np.zeros(len(doc_starts), dtype=bool)
    out[np.searchsorted(doc_starts, hit, side="right") - 1] = True
    return out


def chr_at(data: np.ndarray, at: int) -> str:
    """The three-byte character at a place."""
    return data[at : at + 3].tobytes().decode("utf-8", "replace")


class Encoder:
    """Ids of a tokenizer file, special tokens' strings taken as ordinary text."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            ranks = byte_level_ranks(json.load(f))
        self.merge = None
        if ranks:
            import tiktoken

            self.merge = tiktoken.Encoding("ranks", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
            self.token_bytes = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
            for token, i in ranks.items():
                self.token_bytes[i] = len(token)
            self.table = PieceTable()

    def encode_whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch(texts, add_special_tokens=False)
        return [np.asarray(x.ids, dtype="<u4").tobytes() for x in found]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        if self.merge is None:
            return self.encode_whole(texts)
        raw, out, at = [t.encode("utf-8") for t in texts], [], 0
        while at < len(raw):
            end, n = at, 0
            while end < len(raw) and (end == at or n + len(raw[end]) <= BLOCK_BYTES):
                n += len(raw[end])
                end += 1
            out += self._block(texts[at:end], raw[at:end])
            at = end
        return out

    def _block(self, texts: list[str], raw: list[bytes]) -> list[bytes]:
        out = [b""] * len(texts)
        filled = [k for k, r in enumerate(raw) if r]
        if not filled:
            return out
        bounds = np.concatenate([[0], np.cumsum([len(raw[k]) for k in filled])])
        data = np.frombuffer(b"".join(raw), dtype=np.uint8)
        odd = odd_documents(data, bounds[:-1])
        whole = [k for k, o in zip(filled, odd, strict=True) if o]
        for k, ids in zip(whole, self.encode_whole([texts[k] for k in whole]), strict=True):
            out[k] = ids
        if len(whole) == len(filled):
            return out
        if whole:
            filled = [k for k, o in zip(filled, odd, strict=True) if not o]
            bounds = np.concatenate([[0], np.cumsum([len(raw[k]) for k in filled])])
            data = np.frombuffer(b"".join(raw[k] for k in filled), dtype=np.uint8)
        begin = (data == 32) | (data == 10)
        begin[bounds[:-1]] = True
        starts = np.flatnonzero(begin)
        h = hash_pieces(data, starts)
        slots = self.table.find(h)
        if self.table.entries > self.table.most:
            self.table.clear()
            slots[:] = -1
        while (slots < 0).any():
            self._learn(data, starts, h, np.flatnonzero(slots < 0))
            slots = self.table.find(h)
        first, counts = self.table.first[slots], self.table.number[slots].astype(np.int64)
        ends = np.cumsum(counts)
        ids = self.table.pool[np.repeat(first - (ends - counts), counts) + np.arange(ends[-1])].tobytes()
        upto = np.concatenate([[0], ends])[np.searchsorted(starts, bounds)] * 4
        for k, a, b in zip(filled, upto[:-1].tolist(), upto[1:].tolist(), strict=True):
            out[k] = ids[a:b]
        return out

    def _learn(self, data: np.ndarray, starts: np.ndarray, h: np.ndarray, missing: np.ndarray) -> None:
        """Encode pieces that are not held yet, in one call: each is cut off from the next as in a text."""
        _, at = np.unique(h[0, missing], return_index=True)
        missing = missing[at]
        ends = np.append(starts[1:], len(data))
        buffer = data.tobytes()
        joined, lengths, extra, alone = [], [], [], []
        for k in missing.tolist():
            piece = buffer[starts[k] : ends[k]]
            if piece in (b" ", b"\n"):
                alone.append((k, piece))
                continue
            lead = piece[0] not in b" \n"
            joined.append(b"\n" + piece if lead else piece)
            lengths.append(len(piece) + lead)
            extra.append(lead)
        for k, piece in alone:
            ids = np.asarray(self.merge(piece.decode()), dtype="<u4")
            self.table.add(h[:, [k]], ids, np.array([len(ids)]))
        missing = np.array([k for k in missing.tolist() if k not in {x for x, _ in alone}], dtype=np.int64)
        if not len(missing):
            return
        ids = np.asarray(self.merge(b"".join(joined).decode("utf-8")), dtype="<u4")
        upto = np.searchsorted(np.cumsum(self.token_bytes[ids]), np.cumsum(lengths)) + 1
        counts = np.diff(np.concatenate([[0], upto]))
        # The line break put in front of a text's first piece is a token of its own.
        lead = np.array(extra)
        keep = np.ones(len(ids), dtype=bool)
        keep[(upto - counts)[lead]] = False
        self.table.add(h[:, missing], ids[keep], counts - lead)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of a file, kept by the worker for its next tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def public_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def piece_bounds(n: int, size: int) -> list[tuple[int, int]]:
    """``(start, length)`` of the pieces of ``n`` ids: only the first may be shorter than ``size``."""
    first = n % size or min(n, size)
    bounds = [(0, first)] if n else []
    bounds += [(s, size) for s in range(first, n, size)]
    return bounds


def document_ids(found: Encoder, texts: list[str | None], end_id: int) -> list[bytes]:
    """Ids of the documents, each followed by the end id; null text is empty."""
    end = np.asarray([end_id], dtype="<u4").tobytes()
    return [x + end for x in found.encode([t or "" for t in texts])]
