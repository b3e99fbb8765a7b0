"""BPE encoding and decoding with forced boundaries.

For vocabularies of byte-level BPE with word ends (lower case, white space dropped). A pair of
neighbouring bytes that stands inside no token of the vocabulary can never be merged across, so a
word is certain to be cut there. The cuts part a word into fragments that are encoded
independently of each other, by merges in order of rank, and then concatenated. Fragments repeat
far more than words and are remembered, in a bounded table.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Memory, arrow_map, byte_letters, pieces, utf8

#: Fragments and words that a worker remembers; they outlive its tasks.
FRAGMENTS, WORDS = 50_000, 200_000
#: Bytes up to which a fragment is merged without a queue.
SHORT, NONE = 40, (1 << 62, 0)
#: Beyond these characters the library's own tables decide what a letter is.
BEYOND = re.compile(r"[^\x00-ſ]")
#: The vocabulary's pattern, over lower-cased text of characters up to U+017F.
LATIN = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d"
    r"|[a-z\xaa\xb5\xba\xdf-\xf6\xf8-ſ]+"
    r"|[0-9\xb2\xb3\xb9\xbc-\xbe]"
    r"|[^a-z0-9\xaa\xb5\xba\xdf-\xf6\xf8-ſ\xb2\xb3\xb9\xbc-\xbe\t-\r \x85\xa0]+"
)
END = "</w>"


class ForcedBpe:
    """Encoder and decoder of a vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            made = json.load(file)
        model = made["model"]
        vocab = model["vocab"]
        self.path = path
        self.letter = byte_letters()
        byte = {c: b for b, c in self.letter.items()}
        self.first = [vocab[self.letter[b]] for b in range(256)]
        self.last = [vocab[self.letter[b] + END] for b in range(256)]
        self.merges = {}
        for rank, (a, b) in enumerate(model["merges"]):
            self.merges[vocab[a], vocab[b]] = (rank, vocab[a + b])
        self.tokens = {i: t for t, i in vocab.items()}
        self.decimals = {i: str(i) for i in range(max(vocab.values()) + 256)}
        self.special = {x["content"]: x["id"] for x in made["added_tokens"]}
        self.tokens |= {i: t for t, i in self.special.items()}
        self.marks = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        # pairs of bytes inside some token; those before a word's last byte are kept apart
        self.inner, self.inner_last = set(), set()
        for token in vocab:
            ended = token.endswith(END) and len(token) > len(END)
            own = [byte[c] for c in (token[: -len(END)] if ended else token)]
            pairs = list(zip(own, own[1:], strict=False))
            if ended and pairs:
                self.inner_last.add(pairs.pop())
            self.inner.update(pairs)
        self.fragments = Memory(self._merge, FRAGMENTS)
        self.known = Memory(self._word, WORDS)

    def cuts(self, word: bytes) -> Iterator[tuple[bytes, bool]]:
        """The fragments of a word, and whether each ends it."""
        at, last = 0, len(word) - 1
        for k in range(last):
            pair = (word[k], word[k + 1])
            if pair not in (self.inner_last if k + 1 == last else self.inner):
                yield word[at : k + 1], False
                at = k + 1
        yield word[at:], True

    def _word(self, word: str) -> tuple[int, ...]:
        found = self.cuts(word.encode())
        return tuple(chain.from_iterable(self.fragments[x + (b"\1" if e else b"\0")] for x, e in found))

    def _merge(self, key: bytes) -> tuple[int, ...]:
        """Ids of a fragment; the key's last byte tells whether the fragment ends a word."""
        own = [self.first[b] for b in key[:-1]]
        if key[-1]:
            own[-1] = self.last[key[-2]]
        if len(own) == 1:
            return tuple(own)
        n = len(own)
        if n <= SHORT:
            return self._merge_short(own)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        merges = self.merges
        queue = []
        for k in range(n - 1):
            merge = merges.get((own[k], own[k + 1]))
            if merge:
                queue.append((merge[0], k, own[k], own[k + 1], merge[1]))
        heapq.heapify(queue)
        while queue:
            _, k, a, b, made = heapq.heappop(queue)
            right = after[k]
            if own[k] != a or right >= n or own[right] != b:
                continue
            own[k], own[right] = made, -1
            after[k] = after[right]
            if after[k] < n:
                before[after[k]] = k
                merge = merges.get((made, own[after[k]]))
                if merge:
                    heapq.heappush(queue, (merge[0], k, made, own[after[k]], merge[1]))
            if before[k] >= 0:
                left = before[k]
                merge = merges.get((own[left], made))
                if merge:
                    heapq.heappush(queue, (merge[0], left, own[left], made, merge[1]))
        return tuple(x for x in own if x >= 0)

    def _merge_short(self, own: list[int]) -> tuple[int, ...]:
        """The same by looking for the least rank again after each merge."""
        get = self.merges.get
        found = [get(x, NONE) for x in zip(own, own[1:], strict=False)]
        while found:
            best = min(found)
            if best is NONE:
                break
            k = found.index(best)
            own[k : k + 2] = [best[1]]
            del found[k]
            if k < len(found):
                found[k] = get((own[k], own[k + 1]), NONE)
            if k:
                found[k - 1] = get((own[k - 1], own[k]), NONE)
        return tuple(own)

    @property
    def library(self):
        """The library's normalizer and splitter, for text beyond Latin letters."""
        if not hasattr(self, "_library"):
            from tokenizers import Tokenizer

            made = Tokenizer.from_file(self.path)
            self._library = made.normalizer, made.pre_tokenizer
            self._byte = {c: b for b, c in self.letter.items()}
        return self._library

    def _words(self, text: str) -> list[str]:
        if not BEYOND.search(text):
            return LATIN.findall(text.lower())
        normalizer, splitter = self.library
        found = splitter.pre_tokenize_str(normalizer.normalize_str(text))
        return [bytes(self._byte[c] for c in x).decode() for x, _ in found]

    def encode(self, text: str) -> list[int]:
        if "<|" not in text:
            return list(chain.from_iterable(map(self.known.__getitem__, self._words(text))))
        out: list[int] = []
        for part in self.marks.split(text):
            if part in self.special:
                out.append(self.special[part])
            else:
                out += chain.from_iterable(map(self.known.__getitem__, self._words(part)))
        return out

    def decode(self, ids: list[int]) -> str:
        """Tokens joined by spaces, as of a tokenizer without decoder; unknown ids are passed over."""
        tokens = self.tokens
        try:
            return " ".join(map(tokens.__getitem__, ids))
        except KeyError:
            return " ".join(tokens[i] for i in ids if i in tokens)


@lru_cache(2)
def load(path: str) -> ForcedBpe:
    return ForcedBpe(path)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), utf8(text_col).alias("text"))


def encode(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, ids``: the token ids of each row; null texts count as empty and have no ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in batches:
            for first, texts in pieces(batch.column(1)):
                ids = [np.array(bpe.encode(x.decode("utf-8", "replace")), np.int32) for x in texts]
                ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, len(texts)),
                        pa.ListArray.from_arrays(ends, np.concatenate(ids)),
                    ],
                    ["doc_id", "ids"],
                )

    return arrow_map(_texts(docs, id_col, text_col), run, "doc_id long, ids array<int>")


def decode(
    encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids"
) -> DataFrame:
    """``doc_id, text``: the decoded text of each row; null ids give a null text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in batches:
            texts = [None if (x := ids.as_py()) is None else bpe.decode(x) for ids in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"]
            )

    kept = encoded.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids")
    )
    return arrow_map(kept, run, "doc_id long, text string")


def round_trip(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: encode and decode where the text is.

    The digests are of the ids in decimal, joined by one space, and of the decoded text. Neither
    leaves its task, so nothing but digests is moved.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in batches:
            counts, ids_hex, text_hex = [], [], []
            for text in batch.column(1):
                ids = bpe.encode(text.as_py().decode("utf-8", "replace"))
                counts.append(len(ids))
                ids_hex.append(hashlib.sha256(" ".join(map(bpe.decimals.__getitem__, ids)).encode()).hexdigest())
                text_hex.append(hashlib.sha256(bpe.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(counts, pa.int64()),
                    pa.array(ids_hex, pa.string()),
                    pa.array(text_hex, pa.string()),
                ],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return arrow_map(
        _texts(docs, id_col, text_col),
        run,
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
    )
