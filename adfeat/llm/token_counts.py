"""Token counts by a whole-token shortcut (operator 3).

Once per worker, the vocabulary is proved offline: a vocabulary string is a whole token if
the library, given it alone, splits it into one pre-token and returns exactly one token.
A document's pre-tokens that are such strings count 1 without any merging; the merges run
only for the other distinct pre-tokens, whose counts are kept for later documents.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The split pattern of the vocabulary's pre-tokenizer (fixed value).
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

#: Texts of these characters alone are normalised by lower() exactly as by the library's normaliser.
_PLAIN = re.compile("[^\t\n\r -~\xa1-\xff]")

#: Bounded working sets of a worker: remembered pre-tokens, and text looked at together.
REMEMBER, TOGETHER = 400_000, 1 << 20


class WholeTokenCounter:
    """Counts tokens of texts exactly as ``tokenizers`` does without special tokens added."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.specials = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.split = regex.compile(SPLIT).findall
        self.whole = self.prove()
        self.known = dict.fromkeys(self.whole, 1)

    def prove(self) -> list[str]:
        """Vocabulary strings that alone are one pre-token and encode as one token."""
        words = {w for t in self.library.get_vocab(with_added_tokens=False) if t.endswith("</w>") for w in (self._text(t[:-4]),) if w}
        words = sorted(w for w in words if self.split(w) == [w] and self.library.normalizer.normalize_str(w) == w)
        return [w for w, e in zip(words, self.library.encode_batch(words, add_special_tokens=False), strict=True) if len(e.ids) == 1]

    def _text(self, token: str) -> str | None:
        try:
            return bytes(_byte_of()[c] for c in token).decode()
        except (KeyError, UnicodeDecodeError):
            return None

    def count(self, texts: list[str]) -> list[int]:
        plain, pieces, out = [], [], [0] * len(texts)
        other = []
        for i, t in enumerate(texts):
            if (t.isascii() or not _PLAIN.search(t)) and not any(s in t for s in self.specials) and not _CONTROL.search(t):
                plain.append(i)
                pieces.append(self.split(t.lower()))
            else:
                other.append(i)
        unknown = list(set().union(*pieces).difference(self.known))
        if len(self.known) + len(unknown) > REMEMBER + len(self.whole):
            self.known = dict.fromkeys(self.whole, 1)
            unknown = list(set().union(*pieces).difference(self.known))
        if unknown:
            self.known.update(zip(unknown, (len(e.ids) for e in self.library.encode_batch_fast(unknown, add_special_tokens=False)), strict=True))
        known = self.known.__getitem__
        for i, p in zip(plain, pieces, strict=True):
            out[i] = sum(map(known, p))
        if other:
            for i, e in zip(other, self.library.encode_batch_fast([texts[i] for i in other], add_special_tokens=False), strict=True):
                out[i] = len(e.ids)
        return out


#: ASCII controls that the two regular expression engines may class differently.
_CONTROL = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]")


@functools.cache
def _byte_of() -> dict[str, int]:
    """Byte of each printable stand-in of the byte-level alphabet."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@functools.cache
def _counter(path: str) -> WholeTokenCounter:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return WholeTokenCounter(path)


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row's whole text.

    A null or empty text has 0 bytes and tokens; a null id is kept; repeated rows each give a
    row; an empty table gives none.  Other columns are not read, whatever their names.
    One pass, no shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(tokenizer_path)
        for b in batches:
            sizes, tokens, texts, held = [], [], [], 0
            for v in b.column(1):
                t = v.as_py() or ""
                texts.append(t)
                sizes.append(len(t.encode()))
                held += sizes[-1]
                if held > TOGETHER:
                    tokens += counter.count(texts)
                    texts, held = [], 0
            tokens += counter.count(texts)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64()), pa.array([n > limit for n in tokens], pa.bool_())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return source.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
