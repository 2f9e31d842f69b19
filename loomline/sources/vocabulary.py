"""Tokenizer files and vocabulary tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.operators.guards import require_specials
from loomline.sources.word_files import LookUp, id_look_up, word_look_up

BOS, EOS = "[BOS]", "[EOS]"


@dataclass(frozen=True)
class Vocabulary:
    """token, id table and the ids of its special tokens.

    Its look-up files are written when they are first asked for.
    """

    table: DataFrame
    bos: int
    eos: int
    unknown: int | None = None

    @property
    def specials(self) -> list[int]:
        return [i for i in (self.unknown, self.bos, self.eos) if i is not None]

    @cached_property
    def by_word(self) -> LookUp:
        return word_look_up(self.table)

    @cached_property
    def by_id(self) -> LookUp:
        return id_look_up(self.table)


def special_ids(table: DataFrame, names: Sequence[str] = (BOS, EOS)) -> dict[str, int]:
    """Ids of the named tokens; a clear error when one has none."""
    found = {r.token: r.id for r in table.filter(F.col("token").isin(*names)).collect()}
    require_specials(found, names)
    return found


def vocabulary(table: DataFrame, unknown: str | None = "[UNK]") -> Vocabulary:
    names = [BOS, EOS] + ([unknown] if unknown else [])
    ids = special_ids(table, names)
    return Vocabulary(table, ids[BOS], ids[EOS], ids[unknown] if unknown else None)


def read_tokenizer(spark: SparkSession, path: str) -> str:
    """The tokenizer file as one string; it is a few MB at most."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(conf).exists(place):
        raise FileNotFoundError(f"no tokenizer file at {path}")
    return spark.read.text(path, wholetext=True).first().value


def tokenizer_vocabulary(
    spark: SparkSession, tokenizer_json: str, unknown: str | None = None
) -> Vocabulary:
    """The tokenizer's tokens and ids, added tokens included, as a table."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(tokenizer_json)
    ids = {name: tokenizer.token_to_id(name) for name in (BOS, EOS)}
    require_specials(ids, (BOS, EOS))
    entries = sorted(tokenizer.get_vocab(with_added_tokens=True).items(), key=lambda e: e[1])
    table = spark.createDataFrame(entries, "token string, id int")
    return Vocabulary(
        table,
        ids[BOS],
        ids[EOS],
        tokenizer.token_to_id(unknown) if unknown else None,
    )
