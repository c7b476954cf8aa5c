"""Subword ids by the tokenizers library, with a memo over white-space-led chunks.

Byte-level BPE never joins a piece across a step from a non-space character to a space, so
a text may be cut at every blank or line feed that follows a non-space character and the
chunks (each with its leading blank) encoded on their own: the ids are the same as those of
the whole text.  Chunks repeat a lot, so each distinct one of a piece of a batch is looked
up once, and ids of occurrences are gathered by position.

By default a text is encoded as the library does it: the name of a special token inside a
text becomes that token.  ``plain=True`` reads such names as ordinary text.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from . import textual
from .textual import Parts, chunks, gathered

os.environ.setdefault("RAYON_NUM_THREADS", "1")
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

VOCABULARY = "byte_bpe_50k.json"
#: what a worker remembers at most before it forgets rare chunks: chunks, and their characters
MEMO, MEMO_CHARS = 700_000, 12_000_000
_loaded: dict[tuple[str, bool], "Encoder"] = {}


def vocabulary_path(name: str) -> str:
    """A file's place: a path as it is, a bare name among the public vocabularies."""
    if os.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    def __init__(self, vocabulary: str, plain: bool = False):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary_path(vocabulary))
        self.tokenizer.encode_special_tokens = plain
        n = self.tokenizer.get_vocab_size()
        #: bytes of each id; in the byte alphabet a character stands for a byte
        self.bytes_of = np.array([len(self.tokenizer.id_to_token(i) or "") for i in range(n)], np.int64)
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.chars = self.used = 0
        self.ids = np.empty(1 << 16, np.uint32)
        self.starts, self.lengths, self.seen = (np.zeros(1 << 14, np.int64) for _ in range(3))

    def _forget_rare(self) -> None:
        """Keep the chunks seen in most pieces of batches, half of what may be kept at most."""
        found, seen = list(self.place), self.seen[: len(self.place)]
        least = max(2, int(np.partition(seen, len(seen) // 2)[len(seen) // 2]) + 1)
        kept = np.flatnonzero(seen >= least)
        starts, lengths, ids = self.starts[kept], self.lengths[kept], self.ids
        self.forget()
        if len(kept):
            ids, _ = gathered(ids, starts, lengths)
            self._add([found[k] for k in kept.tolist()], ids, lengths)
            self.chars = sum(map(len, self.place))

    def _each(self, found: list[str]) -> tuple[np.ndarray, np.ndarray]:
        got = [e.ids for e in self.tokenizer.encode_batch_fast(found, add_special_tokens=False)]
        lengths = np.fromiter(map(len, got), np.int64, len(got))
        return np.fromiter((i for e in got for i in e), np.uint32, int(lengths.sum())), lengths

    def _cut(self, found: list[str], ids: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Chunks that lead with a blank and end with another character keep their ids when
        strung together; they are cut apart where the ids' bytes meet the chunks' ends."""
        out = np.array(ids, np.uint32)
        ends = np.cumsum(pc.binary_length(pa.array(found, pa.string())).to_numpy().astype(np.int64))
        reached = np.cumsum(self.bytes_of[out])
        cuts = np.searchsorted(reached, ends)
        if not len(reached) or reached[-1] != ends[-1] or not np.array_equal(reached[cuts], ends):
            return self._each(found)
        return out, np.diff(cuts, prepend=-1)

    def _encoded(self, found: list[str]) -> Iterator[tuple[list[str], np.ndarray, np.ndarray]]:
        alone = [c for c in found if c[:1] not in (" ", "\n") or c[-1].isspace()]
        strung = [c for c in found if c[:1] in (" ", "\n") and not c[-1].isspace()]
        parts = [strung[k : k + 500] for k in range(0, len(strung), 500)]
        for at in range(0, len(parts), 50):
            some = parts[at : at + 50]
            for part, e in zip(some, self.tokenizer.encode_batch_fast(["".join(x) for x in some], add_special_tokens=False), strict=True):
                yield part, *self._cut(part, e.ids)
        for at in range(0, len(alone), 10_000):
            yield alone[at : at + 10_000], *self._each(alone[at : at + 10_000])

    def _add(self, part: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        n, used = len(self.place), self.used
        if used + len(ids) > len(self.ids):
            self.ids = np.concatenate((self.ids[:used], np.empty(max(used, len(ids)) + len(ids), np.uint32)))
        if n + len(part) > len(self.starts):
            more = np.zeros(n + len(part), np.int64)
            self.starts, self.lengths, self.seen = (np.concatenate((x[:n], more)) for x in (self.starts, self.lengths, self.seen))
        self.ids[used : used + len(ids)] = ids
        self.lengths[n : n + len(part)] = lengths
        self.starts[n : n + len(part)] = used + np.cumsum(lengths) - lengths
        self.used += len(ids)
        self.place.update(zip(part, range(n, n + len(part))))

    def located(self, parts: Parts) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of every part begin in ``ids``, and how many they are."""
        found = parts.distinct.to_numpy(zero_copy_only=False).tolist()
        at = list(map(self.place.get, found))
        if None in at:
            new = [c for c, x in zip(found, at, strict=True) if x is None]
            chars = sum(map(len, new))
            if self.place and (len(self.place) + len(new) > MEMO or self.chars + chars > MEMO_CHARS):
                self._forget_rare()
                new = [c for c in found if c not in self.place]
                chars = sum(map(len, new))
            self.chars += chars
            for some, ids, lengths in self._encoded(new):
                self._add(some, ids, lengths)
            at = list(map(self.place.__getitem__, found))
        at = np.array(at, np.int64)
        self.seen[at] += 1
        at = at[parts.codes]
        return self.starts[at], self.lengths[at]

    def parts(self, parts: Parts) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one behind the other, and the offsets of the texts."""
        starts, lengths = self.located(parts)
        ids, ends = gathered(self.ids, starts, lengths)
        return ids, np.r_[0, ends][parts.offsets]

    def encode(self, texts: pa.Array, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (null: empty) one behind the other, each with ``end_id`` behind
        its own, and the offsets of the texts."""
        ids, offsets = self.parts(chunks(texts))
        if end_id is not None:
            ids = np.insert(ids, offsets[1:], end_id)
            offsets = offsets + np.arange(len(offsets))
        return ids, offsets


def encoder(vocabulary: str = VOCABULARY, plain: bool = False) -> Encoder:
    """The worker's encoder; it outlives tasks, as Spark reuses Python workers."""
    if (vocabulary, plain) not in _loaded:
        _loaded[vocabulary, plain] = Encoder(vocabulary, plain)
    return _loaded[vocabulary, plain]


def crc(data) -> int:
    return zlib.crc32(data) & 0xFFFFFFFF


pieces = textual.pieces
