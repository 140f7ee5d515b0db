"""Promotion-channel rules: defaults, three-part split and the length gate."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the channel contract.
BLANK_CHANNEL = "21"
NULL_MARK = "\\N"
NULL_CHANNEL = "pyw"
PART_LIMITS = (10, 10, 15)
PARTS = ("parent_channel", "child_channel", "ad_label")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_default(c: Column | str) -> Column:
    """Warehouse form of the default: only the blank is replaced, nulls stay null."""
    c = _col(c)
    return F.when(c == "", F.lit(BLANK_CHANNEL)).otherwise(c)


def default_channel(c: Column | str) -> Column:
    """Log form of the default: blank and the export's null mark are both replaced."""
    c = _col(c)
    return F.when(c == "", F.lit(BLANK_CHANNEL)).when(c == NULL_MARK, F.lit(NULL_CHANNEL)).otherwise(c)


def channel_parts(c: Column | str) -> list[Column]:
    """The three key parts of a channel.

    Fewer than three parts keep the whole text in the first one; a fourth part and later
    ones are ignored; trailing blanks do not count as parts.
    """
    c = _col(c)
    parts = F.split(F.regexp_replace(c, "_+$", ""), "_")
    blank = c.isin("", "0")
    short = F.size(parts) < 3
    whole = F.when(blank, F.lit(BLANK_CHANNEL)).when(short, c).otherwise(F.get(parts, F.lit(0)))
    rest = [
        F.when(c.isNull(), None).when(blank | short, F.lit("")).otherwise(F.get(parts, F.lit(i))) for i in (1, 2)
    ]
    return [p.alias(n) for p, n in zip([whole, *rest], PARTS)]


def fold_channel(c: Column | str) -> Column:
    """The channel as its key parts see it: one text for all spellings that share a key."""
    c = F.upper(_col(c))
    parts = F.split(F.regexp_replace(c, "_+$", ""), "_")
    three = F.concat_ws("_", *[F.get(parts, F.lit(i)) for i in range(3)])
    short = F.when(c.isin("", "0"), F.lit(BLANK_CHANNEL)).when(F.size(parts) < 3, c)
    return F.when(c.isNotNull(), short.otherwise(three))


def split_channel(df: DataFrame, channel: str = "expand_channel", case: str = "raw") -> DataFrame:
    """Replace the channel column by its three parts; `case="upper"` folds spellings first."""
    source = F.upper(channel) if case == "upper" else F.col(channel)
    others = [c for c in df.columns if c != channel]
    return df.select(*others, *channel_parts(source))


def fits_limits() -> Column:
    checks = [F.length(p) <= n for p, n in zip(PARTS, PART_LIMITS)]
    return F.coalesce(checks[0] & checks[1] & checks[2], F.lit(False))


def gate_channel(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, rejects) by the part lengths; a null channel is a reject."""
    return df.filter(fits_limits()), df.filter(~fits_limits())
