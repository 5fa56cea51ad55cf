"""Corpus encoding, decoding and tokenizer statistics.

Lines are pre-tokenised JVM-side and encoded in one narrow pass (Arrow UDF with a
per-worker cache of pre-token ids). Decoding is a narrow pass as well.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from ..functions import pretok as PT
from ..functions.tokens import SPECIAL_TOKENS, UNK_ID, with_template
from . import bpe as B

EVAL_SAMPLES = 50_000


def tokenize_lines(spark: SparkSession, lines: DataFrame, model: B.BpeModel, key_cols: list[str],
                   text_col: str = "text", template: bool = True, normalize: bool = True) -> DataFrame:
    """P18 (+P19): ids per line as ``tokens ARRAY<INT>`` and ``n_tokens``.

    One narrow pass: NFKC (non-ASCII rows only), JVM-side pre-tokenisation, then an Arrow
    UDF that encodes the line's pre-tokens through a per-worker cache. No shuffle, so a
    very frequent pre-token cannot skew a join.
    """
    df = lines.select(*key_cols, F.col(text_col).alias("_t"))
    if normalize:
        df = PT.nfkc_frame(df, "_t")
    enc = B.line_encoder_udf(spark, model)
    ids = enc(PT.pretokens(F.col("_t")))
    tok = with_template(ids) if template else ids
    return df.select(*key_cols, tok.alias("tokens")).withColumn("n_tokens", F.size("tokens"))


def vocab_lookup(spark: SparkSession, model: B.BpeModel) -> DataFrame:
    """Token <-> id table (vocabulary-bounded, safe to broadcast)."""
    return F.broadcast(model.vocab_frame(spark))


def decode(spark: SparkSession, tok: DataFrame, model: B.BpeModel, key_cols: list[str],
           skip_special: bool = True) -> DataFrame:
    """P20: ids -> text through the byte-level vocabulary, one narrow pass without a shuffle.

    Invalid UTF-8 (a sequence may cut a character) becomes U+FFFD; a line of special tokens only
    (or without any id) is an empty text, a null token array a null text.
    """
    first = len(SPECIAL_TOKENS) if skip_special else 0
    table = spark.sparkContext.broadcast({i: b for i, b in model.vocab.items() if i >= first})  # the vocabulary

    @F.pandas_udf(Ty.StringType())
    def text_of(ids: pd.Series) -> pd.Series:
        get = table.value.get
        return ids.map(lambda x: None if x is None else b"".join([get(int(i), b"") for i in x]).decode("utf-8", "replace"))

    return tok.select(*key_cols, text_of(F.col("tokens")).alias("decoded"))


def eval_sample(corpus: DataFrame, order_cols: list[str], n: int = EVAL_SAMPLES) -> DataFrame:
    """L2: the first ``n`` lines in corpus order (top-k: the limit is the feature)."""
    return corpus.orderBy(*order_cols).limit(n)


def tokenizer_stats(tok: DataFrame, text_col: str = "text") -> DataFrame:
    """A10: mean/min/max/total tokens per document, unknown ids, characters per token."""
    unk = F.size(F.filter("tokens", lambda t: t == UNK_ID))
    agg = tok.agg(F.count(F.lit(1)).alias("documents"),
                  F.avg("n_tokens").alias("avg_tokens"), F.min("n_tokens").alias("min_tokens"),
                  F.max("n_tokens").alias("max_tokens"), F.sum("n_tokens").cast("long").alias("total_tokens"),
                  F.sum(unk).cast("long").alias("unk_count"),
                  F.sum(F.length(text_col)).cast("long").alias("total_chars"))
    return agg.withColumn("chars_per_token",
                          F.when(F.col("total_tokens") > 0, F.col("total_chars") / F.col("total_tokens"))
                          .otherwise(F.lit(0.0)))


def example(spark: SparkSession, tok_first: DataFrame, model: B.BpeModel, text_col: str = "text") -> DataFrame:
    """L3: first 200 characters, the first 30 tokens (byte-level text) and their ids."""
    rows = [(i, b.decode() if i < len(SPECIAL_TOKENS) else "".join(PT.byte_char(x) for x in b))
            for i, b in model.vocab.items()]
    names = F.broadcast(spark.createDataFrame(rows, "id int, token string"))     # vocabulary-bounded
    first = tok_first.select(F.substring(text_col, 1, 200).alias("sample"),
                             F.slice("tokens", 1, 30).alias("ids"))
    ex = first.select("sample", "ids", F.posexplode("ids").alias("pos", "id")).join(names, "id", "left")
    return ex.groupBy("sample", "ids").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "token"))), lambda x: x["token"]).alias("tokens"))
