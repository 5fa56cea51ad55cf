"""Token-array helpers: template, hash ids, array fingerprints."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

# Special tokens and their ids (pad, bos, eos, unk).
SPECIAL_TOKENS = ["<pad>", "<bos>", "<eos>", "<unk>"]
PAD_ID, BOS_ID, EOS_ID, UNK_ID = 0, 1, 2, 3


def with_template(ids: Column) -> Column:
    """``<bos> ids <eos>``."""
    return F.concat(F.array(F.lit(BOS_ID)), ids, F.array(F.lit(EOS_ID)))


def words(text: Column) -> Column:
    """Whitespace words of a cleaned (single-spaced) text."""
    return F.filter(F.split(text, " "), lambda w: w != "")


SLICE_BYTES = 4 << 20         # of texts that are hashed at once


def _hashed(texts: pa.Array, vocab: int) -> pa.Array:
    """Ids of the words of each text; a distinct word is hashed once, nulls stay null."""
    parts = pc.split_pattern(pc.fill_null(texts, ""), " ")
    at = parts.offsets.to_numpy() - parts.offsets[0].as_py()
    coded = pc.dictionary_encode(parts.flatten())
    distinct = coded.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
    digests = np.frombuffer(b"".join([hashlib.md5(w).digest() for w in distinct]), ">u4")[::4]
    ids = ((digests >> 4) % vocab).astype(np.int32)
    code = coded.indices.to_numpy()
    there = np.array([len(w) > 0 for w in distinct], bool)[code]
    at = np.concatenate(([0], np.cumsum(there)))[at]
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids[code[there]]), mask=texts.is_null())


def hash_ids(text: Column, vocab: int = 32000) -> Column:
    """Token ids without a tokenizer: first 7 hex digits of md5(word) mod ``vocab``.

    Used to check sequence packing against SQL independently of BPE. An Arrow UDF: words repeat so often
    that hashing the distinct ones of a batch is a small part of hashing all.
    """
    @F.arrow_udf("array<int>")
    def ids(texts: pa.Array) -> pa.Array:
        step = max(1, len(texts) * SLICE_BYTES // max(texts.nbytes, SLICE_BYTES))
        return pa.concat_arrays([_hashed(texts.slice(i, step), vocab) for i in range(0, max(len(texts), 1), step)])

    return ids(text)


def array_digest(arr: Column) -> Column:
    """md5 of the comma-joined ids: compares whole sequences as one string."""
    return F.md5(F.array_join(arr, ","))
