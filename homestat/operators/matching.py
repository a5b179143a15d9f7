"""Matching records to parcels: by account, then by address, then by almost the same address."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from homestat.functions.scalars import normalize_address, zip5

# How a record found its parcel.
KINDS = ("account", "address", "near", "none")


def _as_list(x) -> list:
    return [] if x is None else [x] if isinstance(x, str) else list(x)


def address_digits(address: Column) -> Column:
    """All numbers of a normalised address, in order: house number, numbered street, unit."""
    return F.concat_ws(" ", F.regexp_extract_all(address, F.lit("([0-9]+)"), 1))


def _cut(length: Column, i: int, pieces: int) -> Column:
    return F.floor(length * i / pieces).cast("int")


def _own_segments(address: Column, edits: int) -> Column:
    """The address in `edits` + 1 pieces: (its length, which piece, the piece)."""
    n, pieces = F.length(address), edits + 1
    return F.array(*[F.struct(n.alias("size"), F.lit(i).alias("piece"),
                              F.substring(address, _cut(n, i, pieces) + 1, _cut(n, i + 1, pieces) - _cut(n, i, pieces)).alias("text"))
                     for i in range(pieces)])


def _possible_segments(address: Column, edits: int) -> Column:
    """Every piece that an address within `edits` edits may have in common with this one, wherever
    it may lie: one of `edits` + 1 pieces is always untouched and shifted by `edits` at most."""
    n, pieces, out = F.length(address), edits + 1, []
    for more in range(-edits, edits + 1):
        size = n + more
        for i in range(pieces):
            start, stop = _cut(size, i, pieces), _cut(size, i + 1, pieces)
            for shift in range(-edits, edits + 1):
                fits = (size >= 0) & (start + shift >= 0) & (stop + shift <= n)
                out.append(F.when(fits, F.struct(size.alias("size"), F.lit(i).alias("piece"),
                                                 F.substring(address, start + shift + 1, stop - start).alias("text"))))
    return F.array_distinct(F.array_compact(F.array(*out)))


def match_parcels(records: DataFrame, parcels: DataFrame, *, by=(), max_edits: int = 2, key: str = "account_key",
                  address: str = "address", zipcode: str = "zip") -> DataFrame:
    """SC2 at work: each record with the parcel it belongs to.

    Adds `match_kind`, `match_key` and `match_edits` to every record (within `by`):

    * ``account``: the record's own key is a parcel's;
    * else ``address``: same five-digit zip and normalised address;
    * else ``near``: same zip, the same numbers in the address (house, unit) and at most
      `max_edits` edits between the normalised addresses; the fewest edits win;
    * else ``none``, with NULLs.

    Of parcels of one address the smallest key counts, and of equally near ones too. Null or
    empty addresses match nothing; a null zip matches nothing.

    Near addresses come from an equality join: addresses are cut in `max_edits` + 1 pieces,
    one of which an address that near still has. Different addresses are compared once each,
    however many records share one, and only with addresses that share zip, numbers, length
    and piece, so a building with a thousand units is no group of a million pairs. All pairs
    that the rule allows are found. Built-in functions only.
    """
    by = _as_list(by)
    place = [*by, "_m_zip", "_m_address"]

    def placed(df: DataFrame) -> DataFrame:
        return df.withColumns({"_m_zip": zip5(F.col(zipcode)), "_m_address": normalize_address(F.col(address))})

    known = parcels.where(F.col(key).isNotNull()).select(*by, F.col(key).alias("_m_account")).distinct()
    addresses = (placed(parcels).where((F.col("_m_address") != "") & F.col("_m_zip").isNotNull() & F.col(key).isNotNull())
                 .groupBy(*place).agg(F.min(key).alias("_m_key")))
    rows = placed(records).withColumn("_m_account", F.col(key))
    rows = rows.join(known.withColumn("_m_known", F.lit(True)), [*by, "_m_account"], "left").join(addresses, place, "left")

    todo = rows.where(F.col("_m_known").isNull() & F.col("_m_key").isNull() & (F.col("_m_address") != "") & F.col("_m_zip").isNotNull())
    block = [*by, "_m_zip", "_m_digits", "_m_piece"]
    asked = (todo.select(*place).distinct().withColumn("_m_digits", address_digits(F.col("_m_address")))
             .withColumn("_m_piece", F.explode(_possible_segments(F.col("_m_address"), max_edits))))
    offered = (addresses.withColumn("_m_digits", address_digits(F.col("_m_address"))).withColumnRenamed("_m_address", "_m_other")
               .withColumn("_m_piece", F.explode(_own_segments(F.col("_m_other"), max_edits))))
    edits = F.levenshtein(F.col("_m_address"), F.col("_m_other"), max_edits)
    near = asked.join(offered, block).withColumn("_m_edits", edits).where(F.col("_m_edits") >= 0)
    near = near.groupBy(*place).agg(F.min(F.struct("_m_edits", "_m_key")).alias("_m_near"))

    rows = rows.join(near, place, "left")
    account, same, almost = F.col("_m_known").isNotNull(), F.col("_m_key").isNotNull(), F.col("_m_near").isNotNull()
    kind = F.when(account, KINDS[0]).when(same, KINDS[1]).when(almost, KINDS[2]).otherwise(KINDS[3])
    return rows.select(*[F.col(f"`{c}`") for c in records.columns], kind.alias("match_kind"),
                       F.when(account, F.col(key)).when(same, F.col("_m_key")).otherwise(F.col("_m_near._m_key")).alias("match_key"),
                       F.when(account | same, F.lit(0)).otherwise(F.col("_m_near._m_edits")).cast("int").alias("match_edits"))


def match_rates(matched: DataFrame, by=()) -> DataFrame:
    """How many records were matched in each way, and their share (within `by`)."""
    by = _as_list(by)
    counts = matched.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col("match_kind") == k).alias(k) for k in KINDS])
    return counts.select(*by, "_n", F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("n")) for k in KINDS])).alias("_k")) \
        .select(*by, F.col("_k.kind").alias("match_kind"), F.col("_k.n").alias("n"), F.try_divide(F.col("_k.n").cast("double"), F.col("_n")).alias("share"))
