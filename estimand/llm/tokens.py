"""Byte-level BPE ids of whole texts, a block of texts at a time inside tasks.

The tokenizer's pattern never lets a piece cross a single space between two
visible characters (the space starts the next piece), nor a single line break
between them (it is a piece of its own).  So a text falls into segments whose
ids do not depend on each other: each distinct segment of a block is encoded
once and the texts are put together by array indexing.  A text with any other
white space, or with the string of a special token, is encoded as a whole.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Entries of the segment cache kept between blocks; others are encoded anew, so the bound changes no result.
CACHE_ENTRIES = 300_000
#: Bytes of text that are encoded together.
BLOCK_BYTES = 8 << 20
SPACE = r"[\s\p{Z}\x{0b}\x{85}\x{1c}-\x{1f}]"
#: Segments that can't be encoded apart: empty ones, white space at an end (but for one line break before), special strings.
ODD = rf"\A\n?\z|\A\n{SPACE}|\A[^\S\n]|\A[\p{{Z}}\x{{0b}}\x{{85}}\x{{1c}}-\x{{1f}}]|{SPACE}\z|<\|"


def tokenizer_path(name="byte_bpe_50k.json"):
    """Place of a public vocabulary file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """``block(texts)`` gives flat uint32 ids and the offsets of the texts in them (no special tokens added)."""

    def __init__(self, path=None):
        from tokenizers import Tokenizer

        self.path = path or tokenizer_path()
        self.model = Tokenizer.from_file(self.path)
        self.fast = self._ranks()
        self.known = {}
        self.ids, self.starts, self.used = np.zeros(1 << 20, np.uint32), np.zeros(CACHE_ENTRIES + 1, np.int64), 0

    def _ranks(self):
        """The same vocabulary as merge ranks, if that file lies beside the JSON one: its encoder is several times faster."""
        import base64
        import os

        ranks = os.path.splitext(self.path)[0] + ".tiktoken"
        if not os.path.exists(ranks):
            return None
        import public_tokenizers
        import tiktoken

        with open(ranks, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.width = np.zeros(max(table.values()) + 1, np.int64)
        for piece, i in table.items():
            self.width[i] = len(piece)
        return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})

    def whole(self, text):
        if self.fast is None or "<|" in text:
            return np.asarray(self.model.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
        return np.asarray(self.fast.encode_ordinary(text), dtype=np.uint32)

    def _segments(self, segs):
        """Flat ids and start offsets (one more than segments) of distinct segments that are safe to encode apart."""
        known = self.known
        at = np.fromiter((known.get(s, -1) for s in segs), np.int64, len(segs))
        new = np.flatnonzero(at < 0)
        if len(new):
            text = "".join([segs[i] if segs[i][0] == "\n" else " " + segs[i] for i in new])
            ids = np.asarray(self.fast.encode_ordinary(text), dtype=np.uint32)
            ends = np.cumsum(self.width[ids])
            size = np.array([len(segs[i].encode()) + (segs[i][0] != "\n") for i in new], np.int64)
            cut = np.searchsorted(ends, np.cumsum(size)) + 1
            lens = np.diff(cut, prepend=0)
            starts = cut - lens
        lens_all, starts_all = np.empty(len(segs), np.int64), np.empty(len(segs), np.int64)
        old = np.flatnonzero(at >= 0)
        starts_all[old], lens_all[old] = self.starts[at[old]], self.starts[at[old] + 1] - self.starts[at[old]]
        if not len(new):
            return self.ids, starts_all, lens_all
        base = self.starts[len(known)] if len(known) else 0
        room = CACHE_ENTRIES - len(known)
        keep = min(room, len(new))
        flat = np.concatenate([self.ids[:base], ids])
        starts_all[new], lens_all[new] = starts + base, lens
        if keep:
            n = len(known)
            known.update(zip((segs[i] for i in new[:keep]), range(n, n + keep)))
            self.starts[n + 1 : n + keep + 1] = base + cut[:keep]
            self.ids = flat[: base + cut[keep - 1]]
        return flat, starts_all, lens_all

    def block(self, texts):
        texts = texts.cast(pa.large_string()).fill_null("")
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        n = len(texts)
        if self.fast is None:
            return _joined([self.whole(t) for t in texts.to_pylist()])
        parts = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
        bounds = np.asarray(parts.offsets, np.int64)
        bounds = bounds - bounds[0]
        coded = parts.flatten().dictionary_encode()
        words, codes = coded.dictionary, np.asarray(coded.indices, np.int64)
        odd = np.asarray(pc.match_substring_regex(words, ODD))
        apart = np.logical_or.reduceat(odd[codes], bounds[:-1]) if n else np.zeros(0, bool)
        use = np.ones(len(codes), bool)
        use[bounds[:-1]] = False
        use &= np.repeat(~apart, np.diff(bounds))
        wanted = np.zeros(len(words), bool)
        wanted[codes[use]] = True
        slot = np.cumsum(wanted) - 1
        flat, starts, lens = self._segments(words.filter(pa.array(wanted)).to_pylist())
        chosen = slot[codes[use]]
        count = lens[chosen]
        total = np.concatenate([[0], np.cumsum(count)])
        body = flat[np.repeat(starts[chosen] - total[:-1], count) + np.arange(total[-1])]
        seen = np.concatenate([[0], np.cumsum(use)])
        body_at = total[seen[bounds]]
        heads = [self.whole(t) for t in np.where(apart, texts.to_numpy(zero_copy_only=False), words.take(pa.array(codes[bounds[:-1]])).to_numpy(zero_copy_only=False))]
        out = np.empty(body_at[-1] + sum(map(len, heads)), np.uint32)
        offsets = np.zeros(n + 1, np.int64)
        at = 0
        for i, head in enumerate(heads):
            out[at : at + len(head)] = head
            at += len(head)
            k = body_at[i + 1] - body_at[i]
            out[at : at + k] = body[body_at[i] : body_at[i + 1]]
            at += k
            offsets[i + 1] = at
        return out, offsets


def _joined(lists):
    offsets = np.zeros(len(lists) + 1, np.int64)
    np.cumsum([len(x) for x in lists], out=offsets[1:])
    return np.concatenate(lists) if lists else np.zeros(0, np.uint32), offsets


_ENCODERS = {}


def encoder(path=None):
    """One encoder for each worker process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def blocks(texts, limit=BLOCK_BYTES):
    """Ranges of rows with about ``limit`` bytes of text each; a longer text is alone."""
    size = np.asarray(pc.fill_null(pc.binary_length(texts), 0), np.int64)
    start, held = 0, 0
    for i, n in enumerate(size):
        if held and held + n > limit:
            yield start, i
            start, held = i, 0
        held += n
    if start < len(size):
        yield start, len(size)
