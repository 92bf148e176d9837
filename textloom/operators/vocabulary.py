"""Tokenizer settings and the vocabulary table (token, id, freq)."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import asdict, dataclass, replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions.text import strip
from textloom.functions.tokens import decode, tokenize

VOCABULARY_SCHEMA = "token string, id int, freq bigint"

# The end-of-text sign and the sizes of the usual 124M-parameter model.
END_OF_TEXT = "<|endoftext|>"
MODEL_MAX_LENGTH = 1024
VOCABULARY_SIZE = 50257


@dataclass(frozen=True)
class TokenizerSpec:
    """What the token operators need to know besides the vocabulary table."""

    name: str = "word-pieces"
    model_max_length: int = MODEL_MAX_LENGTH
    eos_token: str | None = END_OF_TEXT
    bos_token: str | None = END_OF_TEXT
    unk_token: str = "<|unknown|>"
    pad_token: str | None = None
    mask_token: str | None = None
    add_bos: bool = False
    add_eos: bool = False

    def with_special_tokens(self, overrides: Mapping[str, str] | None = None) -> TokenizerSpec:
        """Override named tokens; a missing pad token becomes the end-of-text token."""
        named = {k: v for k, v in (overrides or {}).items() if k.endswith("_token") and hasattr(self, k)}
        spec = replace(self, **named)
        return spec if spec.pad_token is not None else replace(spec, pad_token=spec.eos_token)

    @property
    def special_tokens(self) -> list[str]:
        """Each special token once; its place is its id."""
        named = (self.eos_token, self.bos_token, self.unk_token, self.pad_token, self.mask_token)
        return list(dict.fromkeys(t for t in named if t is not None))

    def special_id(self, token: str | None) -> int:
        if token is None:
            raise ValueError("this special token is not set")
        return self.special_tokens.index(token)

    @property
    def pad_id(self) -> int:
        return self.special_id(self.pad_token)

    @property
    def unk_id(self) -> int:
        return self.special_id(self.unk_token)


DEFAULT_SPEC = TokenizerSpec().with_special_tokens()


def token_counts(df: DataFrame, text_column: str = "text") -> DataFrame:
    """Occurrences per token; summed inside each task before anything is shuffled."""
    return (
        df.select(F.explode(tokenize(F.col(text_column))).alias("token"))
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("freq"))
    )


def build_vocabulary(
    df: DataFrame,
    max_size: int = VOCABULARY_SIZE,
    spec: TokenizerSpec = DEFAULT_SPEC,
    text_column: str = "text",
) -> DataFrame:
    """Special tokens first, then the most frequent tokens, ties in token order.

    The tokens are first cut at a power of two below which none can make the list,
    read off a histogram of at most 64 rows, so the final top-k sees only a
    multiple of ``max_size`` rows and not every rare token of the corpus.
    """
    special = spec.special_tokens
    room = max_size - len(special)
    if room < 0:
        raise ValueError(f"max_size {max_size} leaves no room for {len(special)} special tokens")
    listed = df.sparkSession.createDataFrame(
        [(token, i, 0) for i, token in enumerate(special)], VOCABULARY_SCHEMA
    )
    counts = token_counts(df, text_column)
    magnitude = F.floor(F.log2("freq")).cast("int")
    above = Window.orderBy(F.desc("magnitude")).rowsBetween(Window.unboundedPreceding, -1)
    needed = (
        counts.groupBy(magnitude.alias("magnitude"))
        .agg(F.count(F.lit(1)).alias("tokens"))
        .withColumn("before", F.coalesce(F.sum("tokens").over(above), F.lit(0)))
        .where(F.col("before") < room)
        .agg(F.coalesce(F.min("magnitude"), F.lit(0)).alias("magnitude"))
    )
    top = (
        counts.where(magnitude >= needed.scalar())
        .orderBy(F.desc("freq"), "token")
        .limit(room)
    )
    # At most max_size rows are left to number.
    number = F.row_number().over(Window.orderBy(F.desc("freq"), "token")) + (len(special) - 1)
    return listed.unionByName(top.select("token", number.cast("int").alias("id"), "freq"))


def vocabulary_digest(vocabulary: DataFrame) -> DataFrame:
    """Size and two sums over the entries' hashes; independent of row order."""
    return vocabulary.select(F.md5(F.concat_ws(":", "id", "token")).alias("h")).agg(
        F.count(F.lit(1)).alias("vocab_size"),
        F.sum(F.conv(F.substring("h", 1, 8), 16, 10).cast("bigint")).alias("low"),
        F.sum(F.conv(F.substring("h", 9, 8), 16, 10).cast("bigint")).alias("high"),
    )


def settings_text(spec: TokenizerSpec) -> str:
    return json.dumps(asdict(spec), sort_keys=True)


def tokenizer_fingerprint(vocabulary: DataFrame, spec: TokenizerSpec = DEFAULT_SPEC) -> DataFrame:
    """16 hex digits over the settings and the vocabulary; one row."""
    text = F.concat_ws("|", F.lit(settings_text(spec)), "vocab_size", "low", "high")
    return vocabulary_digest(vocabulary).select(
        "vocab_size", F.substring(F.sha2(text, 256), 1, 16).alias("fingerprint")
    )


def tokenizer_audit(df: DataFrame, spec: TokenizerSpec = DEFAULT_SPEC, text_column: str = "text") -> DataFrame:
    """Per text: token counts, the first tokens, the decoded text and whether it matches."""
    added = int(spec.add_bos) + int(spec.add_eos)
    text = F.col(text_column)
    return (
        df.withColumn("_tokens", tokenize(text))
        .withColumn("decoded", decode(F.col("_tokens")))
        .withColumns(
            {
                "token_count": F.size("_tokens"),
                "token_count_with_special": F.size("_tokens") + added,
                "tokens": F.slice("_tokens", 1, 10),
                "round_trip_match": strip(text) == strip(F.col("decoded")),
            }
        )
        .drop("_tokens")
    )


def audit_summary(audit: DataFrame) -> DataFrame:
    return audit.agg(
        F.count(F.lit(1)).alias("samples"),
        F.count_if(~F.col("round_trip_match")).alias("mismatches"),
        F.sum("token_count").alias("total_tokens"),
    )


def verify_vocabulary(
    vocabulary: DataFrame, spec: TokenizerSpec = DEFAULT_SPEC, expected_size: int | None = None
) -> DataFrame:
    """One row per check: name, whether it passed, whether failing it is fatal, message."""
    found = vocabulary.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("token") == F.lit(spec.pad_token)).alias("pads"),
    )
    size = F.col("n").cast("string")
    checks = [
        ("pad_token", F.col("pads") > 0, False, F.lit("No pad_token set - may cause issues during training")),
        (
            "model_max_length", F.lit(bool(spec.model_max_length and spec.model_max_length > 0)), True,
            F.lit("model_max_length is not set or invalid"),
        ),
    ]
    if expected_size is not None:
        message = F.concat(
            F.lit("Vocabulary size mismatch: tokenizer has "), size, F.lit(f", expected {expected_size}")
        )
        checks.insert(0, ("vocab_size", F.col("n") == expected_size, True, message))
    rows = [
        F.struct(
            F.lit(name).alias("check"),
            passed.alias("passed"),
            F.lit(fatal).alias("fatal"),
            F.when(passed, "").otherwise(message).alias("warning"),
        )
        for name, passed, fatal, message in checks
    ]
    return found.select(F.inline(F.array(*rows)))
