"""The tokenizers library with a bounded memory of encoded chunks, one per Python worker.

A text is cut before every single blank that a non-space character follows; both vocabularies start a
new pre-token there, so the chunks' ids, joined, are the text's ids. Texts with other runs of white
space beside a blank go to the library whole.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

#: Chunks kept per worker, and the longest chunk that is kept: about 190 MB at most.
KEPT, LONGEST = 1_000_000, 48
#: New chunks that the library gets in one text.
TOGETHER = 1000
_TAIL = ".,!?;:#$%&*|)"


class ChunkEncoder:
    """Chunks are kept without their blank, as the chunk's ids after a blank; first chunks of texts have a table of their own."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.known: dict[str, bytes] = {}
        self.first: dict[str, bytes] = {}
        self.lowers = "Lowercase" in str(self.tokenizer.normalizer)
        # where one chunk's ids end and the next one's begin: a token with the mark of a blank, or of a word's end
        self.suffix = self.tokenizer.model.end_of_word_suffix or ""
        vocabulary = self.tokenizer.get_vocab()
        self.edge = np.zeros(max(vocabulary.values()) + 1, bool)
        self.edge[[i for t, i in vocabulary.items() if (t.endswith(self.suffix) if self.suffix else t.startswith("\u0120"))]] = True

    def _library(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, "<u4").tobytes() for x in found]

    def _after_blank(self, chunks: list[str]) -> dict[str, bytes]:
        """Ids of every chunk after a blank. Many chunks make one text, where its ids can be told apart again."""
        together = [c for c in chunks if len(c) <= LONGEST and (c.isalpha() if self.suffix else "<|" not in c)]
        out: dict[str, bytes] = {}
        groups = [together[i : i + TOGETHER] for i in range(0, len(together), TOGETHER)]
        for group, found in zip(groups, self.tokenizer.encode_batch_fast([" " + " ".join(g) for g in groups], add_special_tokens=False), strict=True):
            ids = np.array(found.ids, "<u4")
            cut = 4 * (np.flatnonzero(self.edge[ids]) + bool(self.suffix))
            cuts = [0, *cut.tolist()] if self.suffix else [*cut.tolist(), 4 * len(ids)]
            if len(cuts) == len(group) + 1 and cuts[0] == 0 and cuts[-1] == 4 * len(ids):  # else some chunk has no edge of its own, or several
                flat = ids.tobytes()
                out.update(zip(group, [flat[a:b] for a, b in zip(cuts, cuts[1:], strict=False)], strict=True))
        alone = [c for c in chunks if c not in out]
        out.update(zip(alone, self._library([" " + c for c in alone]), strict=True))
        return out

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers; null is the empty text."""
        get, out = self.known.get, [b""] * len(texts)
        later: list[tuple[int, list[str], list[bytes | None], list[int]]] = []
        missing: set[str] = set()
        missing_first: set[str] = set()
        for i, text in enumerate(texts):
            if not text:
                continue
            head, *chunks = (_lowered(text) if self.lowers else text).split(" ")
            ids = [self.first.get(head), *map(get, chunks)]
            if None in ids:
                gaps = [k for k, x in enumerate(ids) if x is None]
                chunks.insert(0, head)
                if not gaps[0]:
                    missing_first.add(head)
                missing.update([chunks[k] for k in gaps if k])
                later.append((i, chunks, ids, gaps))
            else:
                out[i] = b"".join(ids)
        if not later:
            return out
        new, heads = self._missing(missing), sorted(missing_first)
        new_first = dict(zip(heads, self._library(heads), strict=True))
        whole = []
        for i, chunks, ids, gaps in later:
            for k in gaps:
                ids[k] = new.get(chunks[k]) if k else new_first[chunks[0]]
            if None in ids:  # white space beside a blank, or a special token after one
                whole.append(i)
            else:
                out[i] = b"".join(ids)
        for i, ids in zip(whole, self._library([texts[i] for i in whole]), strict=True):
            out[i] = ids
        for table, fresh in ((self.known, new), (self.first, new_first)):
            room = KEPT - len(self.known) - len(self.first)
            if room > 0:
                table.update([(k, v) for k, v in fresh.items() if len(k) <= LONGEST][:room])
        return out

    def _missing(self, missing: set[str]) -> dict[str, bytes]:
        """Ids of unknown chunks but those that can't be cut off safely. Closing punctuation after a letter or digit is a pre-token of its own."""
        known, parts, plain = self.known, [], set()
        for chunk in missing:
            if not chunk or chunk[0].isspace() or chunk.startswith("<|"):
                continue
            head = chunk.rstrip(_TAIL)
            if len(head) < len(chunk) and head and head[-1].isalnum() and "<|" not in chunk:
                parts.append((chunk, head, chunk[len(head) :]))
                if head not in known:
                    plain.add(head)
            else:
                plain.add(chunk)
        new = self._after_blank(sorted(plain)) if plain else {}
        tails = sorted({t for _, _, t in parts})
        tail_ids = dict(zip(tails, self._library(tails), strict=True))
        for chunk, head, tail in parts:
            own = known.get(head)
            new[chunk] = (new[head] if own is None else own) + tail_ids[tail]
        return new


def _lowered(text: str) -> str:
    """A Latin-1 text in lower case, as the vocabulary has it anyway: fewer chunks to keep. Other letters are left to the library."""
    if not text.isascii():
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return text
    return text if "<|" in text else text.lower()


@lru_cache(maxsize=2)
def chunk_encoder(path: str) -> ChunkEncoder:
    """The worker's encoder; it lives as long as the worker."""
    return ChunkEncoder(path)


def forget() -> None:
    """Frees the worker's encoders. Workers outlive stages: one that needs no encoder calls this first."""
    chunk_encoder.cache_clear()
