"""Token counts of whole texts, with overlap resynchronisation for huge ones."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import texts as T
from . import tokens as K

#: Texts of more characters are encoded in overlapping chunks.
CHUNK_CHARS = 4_096
OVERLAP_CHARS = 256

COUNTS = "struct<n_tokens:bigint,n_chunks:int,n_widened:int>"


def _starts(encoding, base: int, low: int, high: int) -> dict[int, int]:
    """Places between ``low`` and ``high`` at which a pre-token begins, each with its token's number."""
    at = None
    for place in range(max(low - base, 0), max(high - base, 0) + 1):
        if (at := encoding.char_to_token(place)) is not None:
            break
    found: dict[int, int] = {}
    if at is None:
        return found
    while at > 0 and encoding.token_to_chars(at - 1)[0] + base >= low:
        at -= 1
    before = encoding.token_to_word(at - 1) if at else -1
    while at < len(encoding):
        place = encoding.token_to_chars(at)[0] + base
        if place > high:
            break
        word = encoding.token_to_word(at)
        if place >= low and (word is None or word != before):
            found.setdefault(place, at)
        before, at = word, at + 1
    return found


def encode_spliced(tokenizer, text: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> tuple[list[int], int, int]:
    """Ids of ``text`` from overlapping chunks, the number of chunks encoded, and how often an overlap was widened.

    For byte-level tokenizers without a normaliser.  Two neighbouring chunks are spliced where both
    begin a pre-token: the left one's boundary is a true one, since its start is, and since it lies
    further from the chunk's end than the pattern, or a special token, can look ahead; and the right
    one goes on from there as the whole text would, since the pattern never looks behind.  Where an
    overlap has no such place it is doubled, and in the end the left chunk grows instead.
    """
    special = max((len(t.content) for t in tokenizer.get_added_tokens_decoder().values()), default=0)
    ahead = special + 4
    chunk, overlap = max(chunk, 2 * ahead + 2), max(overlap, ahead + 1)
    overlap = min(overlap, chunk - 1)
    whole = lambda a, b: tokenizer.encode(text[a:b], add_special_tokens=False)
    ids: list[int] = []
    base, end, taken = 0, min(chunk, len(text)), 0
    left, chunks, widened = whole(base, end), 1, 0
    while end < len(text):
        span = overlap
        while True:
            begin = end - span
            if begin <= base:  # the overlap has reached the left chunk's start
                end = min(len(text), end + max(chunk, end - base))
                left, chunks = whole(base, end), chunks + 1
                break
            stop = min(len(text), begin + max(chunk, 2 * span))
            right, chunks = whole(begin, stop), chunks + 1
            ours = _starts(left, base, begin, end - ahead)
            theirs = _starts(right, begin, begin, end - ahead)
            common = [p for p in ours if p in theirs and ours[p] >= taken]
            if common:
                p = common[-1]
                ids += left.ids[taken : ours[p]]
                left, base, end, taken = right, begin, stop, theirs[p]
                break
            widened, span = widened + 1, 2 * span
    return ids + left.ids[taken:], chunks, widened


def count_tokens(text: Column | str, path: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> Column:
    """A struct of n_tokens, n_chunks and n_widened for a column of text.

    Counts are the library's, of whole texts, without added special tokens; null counts as empty.
    Tokenizers for which splices aren't proven get huge texts whole.
    """

    def counted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        memo, spliced = K.memo(path), K.kind(path) == "bytes"
        for batch in batches:
            tokens, chunks, wide = [], [], []
            for part in T.slices(batch, T.LARGE_SLICE):
                chars = np.asarray(pc.utf8_length(part))
                huge = (chars > chunk) if spliced else np.zeros(len(part), bool)
                _, starts = memo.encode(pc.if_else(pa.array(huge), "", part))
                n, c, w = np.diff(starts), np.ones(len(part), np.int32), np.zeros(len(part), np.int32)
                for i in np.flatnonzero(huge):
                    ids, c[i], w[i] = encode_spliced(memo.tokenizer, part[i].as_py(), chunk, overlap)
                    n[i] = len(ids)
                tokens.append(n), chunks.append(c), wide.append(w)
            join = lambda x, t: pa.array(np.concatenate(x) if x else [], t)
            yield pa.StructArray.from_arrays([join(tokens, pa.int64()), join(chunks, pa.int32()), join(wide, pa.int32())], ["n_tokens", "n_chunks", "n_widened"])

    counted.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(counted, COUNTS)(F.col(text) if isinstance(text, str) else text)


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 1024) -> DataFrame:
    """One row for each document: its id, n_bytes, n_tokens, over_limit, n_chunks and n_widened.

    No shuffle.  A null text counts as empty; repeated ids give repeated rows; other columns of
    ``docs`` are ignored, so they may have any names; an empty table gives an empty result.
    """
    text = F.coalesce(docs[text_col], F.lit(""))
    counted = docs.select(docs[id_col].alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), count_tokens(docs[text_col], path).alias("c"))
    return counted.select("doc_id", "n_bytes", F.col("c.n_tokens").alias("n_tokens"), (F.col("c.n_tokens") > limit).alias("over_limit"), F.col("c.n_chunks").alias("n_chunks"), F.col("c.n_widened").alias("n_widened"))
