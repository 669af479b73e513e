"""Hilbert-curve sharding: quantised metadata dimensions, a curve index, runs of the sorted rows.

Rows that are near in all dimensions get near indices, so a shard is a small box in each of them and a reader with a filter
on any dimension skips most shards. Runs are cut by rank: row counts of shards differ by at most one (law `rows`).
Ties on the curve go by id, text checksum and size, so a value that a third of all rows share is spread like any other. Null
texts have no bytes and checksum 0; null metadata is dimension value 0. Repeated rows get places of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, global_rank

BITS = 8


def hilbert(df: DataFrame, dims: list[Column], bits: int = BITS, out: str = "curve") -> DataFrame:
    """df with the Hilbert index of integer dimensions in [0, 2^bits): the axes are turned level by level from the highest bit
    (reflect or swap below it), Gray-coded and interleaved. Each turn is a projection, so no expression is expanded twice."""
    names = [fresh(df, f"__h{i}") for i in range(len(dims))]
    cur = df.select("*", *(d.cast("long").alias(n) for d, n in zip(dims, names)))

    def turn(changes: dict[str, Column]) -> DataFrame:
        return cur.select(*(changes.get(c, F.col(c)).alias(c) for c in cur.columns))

    first, last = names[0], names[-1]
    for level in range(bits - 1, 0, -1):
        low = F.lit((1 << level) - 1)
        for name in names:
            high = F.col(name).bitwiseAND(F.lit(1 << level)) != 0
            swap = F.col(first).bitwiseXOR(F.col(name)).bitwiseAND(low)
            changes = {first: F.when(high, F.col(first).bitwiseXOR(low)).otherwise(F.col(first).bitwiseXOR(swap))}
            if name != first:
                changes[name] = F.when(high, F.col(name)).otherwise(F.col(name).bitwiseXOR(swap))
            elif name == first:
                changes[first] = F.when(high, F.col(first).bitwiseXOR(low)).otherwise(F.col(first))
            cur = turn(changes)
    for a, b in zip(names, names[1:]):
        cur = turn({b: F.col(b).bitwiseXOR(F.col(a))})
    fold = fresh(cur, "__fold")
    parity = F.lit(0).cast("long")
    for level in range(bits - 1, 0, -1):
        parity = parity.bitwiseXOR(F.when(F.col(last).bitwiseAND(F.lit(1 << level)) != 0, F.lit((1 << level) - 1).cast("long")).otherwise(F.lit(0).cast("long")))
    cur = cur.withColumn(fold, parity)
    cur = turn({n: F.col(n).bitwiseXOR(F.col(fold)) for n in names})
    index = F.lit(0).cast("long")
    for level in range(bits - 1, -1, -1):
        for name in names:
            index = index * 2 + F.shiftright(F.col(name), level).bitwiseAND(F.lit(1))
    return cur.select(*df.columns, index.alias(out))


def category(c: Column) -> Column:
    """A category's place on its axis: a checksum bucket, so that places need no dictionary and stay as data grows."""
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % F.lit(255) + 1, F.lit(0))


def magnitude(c: Column) -> Column:
    """A size's place on its axis: eighths of its binary logarithm."""
    return F.coalesce(F.least(F.lit((1 << BITS) - 1), F.floor(F.log2(F.greatest(c, F.lit(0)) + 1) * 8)), F.lit(0)).cast("long")


def shards(docs: DataFrame, count: int = 24, categories: tuple[str, ...] = ("lang", "source"), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, size, text_crc32, curve, shard, slot) of every row; texts don't move, only sizes and checksums do."""
    data = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    rows = docs.select(F.col(id_col).alias("id"), (F.octet_length(data) + 8).cast("long").alias("size"), F.crc32(data).alias("text_crc32"), *(category(docs[c]).alias(f"axis{i}") for i, c in enumerate(categories)))
    placed = hilbert(rows, [*(F.col(f"axis{i}") for i in range(len(categories))), magnitude(F.col("size"))])
    ranked = global_rank(placed.select("id", "size", "text_crc32", "curve"), ["curve", "id", "text_crc32", "size"], "place")
    total = ranked.count()
    each, more = divmod(total, count)
    at, wide = F.col("place"), more * (each + 1)
    shard = F.when(at < wide, F.floor(at / F.lit(each + 1))).otherwise(more + F.floor((at - wide) / F.lit(max(1, each)))).cast("int")
    start = F.when(F.col("shard") < more, F.col("shard").cast("long") * (each + 1)).otherwise(wide + (F.col("shard").cast("long") - more) * each)
    return ranked.withColumn("shard", shard).withColumn("slot", at - start).select(F.col("id").alias(id_col), "size", "text_crc32", "curve", "shard", "slot")


def bounds(placed: DataFrame) -> DataFrame:
    """What a reader prunes by: per shard its rows, bytes, and least and greatest size and curve index."""
    return placed.groupBy("shard").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("size").alias("n_bytes"), F.min("size").alias("min_size"), F.max("size").alias("max_size"), F.min("curve").alias("min_curve"), F.max("curve").alias("max_curve"))


def shards_sql(count: int = 24, categories: tuple[str, ...] = ("lang", "source"), bits: int = BITS) -> str:
    """DuckDB SQL for `shards` over documents (doc_id, text and the categories): the same turns, one projection each."""
    crc = lambda data: f"xor(list_reduce(list_prepend(cast(4294967295 as bigint), list_transform(range(octet_length({data})), lambda i: cast('0x' || hex(array_slice({data}, i + 1, i + 1)) as bigint))), lambda x, byte: xor(x >> 8, t[(xor(x, byte) & 255) + 1])), 4294967295)"
    names = [f"h{i}" for i in range(len(categories) + 1)]
    first, last, step, out = names[0], names[-1], 0, []

    def turn(changes: dict[str, str]) -> None:
        nonlocal step
        out.append(f"s{step + 1} as (select id, size, text_crc32, {', '.join(f'{changes.get(n, n)} {n}' for n in names)} from s{step})")
        step += 1

    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for name in names:
            high, swap = f"{name} & {1 << level} <> 0", f"xor({first}, {name}) & {low}"
            if name == first:
                turn({first: f"case when {high} then xor({first}, {low}) else {first} end"})
            else:
                turn({first: f"case when {high} then xor({first}, {low}) else xor({first}, {swap}) end", name: f"case when {high} then {name} else xor({name}, {swap}) end"})
    for a, b in zip(names, names[1:]):
        turn({b: f"xor({b}, {a})"})
    fold = "cast(0 as bigint)"
    for level in range(bits - 1, 0, -1):
        fold = f"xor({fold}, case when {last} & {1 << level} <> 0 then {(1 << level) - 1} else 0 end)"
    turn({n: f"xor({n}, {fold})" for n in names})
    index = " + ".join(f"((({n} >> {level}) & 1) << {level * len(names) + len(names) - 1 - k})" for level in range(bits) for k, n in enumerate(names))
    axes = ", ".join(f"coalesce((select p from places where v = cast({c} as varchar)), 0) h{i}" for i, c in enumerate(categories))
    listed = " union ".join(f"select cast({c} as varchar) v from documents where {c} is not null" for c in categories)
    return f"""
        with crc(n, c) as (select range, list_reduce(list_prepend(range, range(8)), lambda x, i: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end) from range(256)),
        crcs as (select list(c order by n) t from crc),
        places as (select v, {crc('encode(v)')} % 255 + 1 p from (select distinct v from ({listed})), crcs),
        b as (select doc_id id, encode(coalesce(text, '')) data, {axes} from documents),
        s0 as (select id, octet_length(data) + 8 size, {crc('data')} text_crc32, {', '.join(names[:-1])}, cast(least({(1 << bits) - 1}, floor(ln(octet_length(data) + 9) / ln(2) * 8)) as bigint) {last} from b, crcs),
        {', '.join(out)},
        r as (select id, size, text_crc32, {index} curve, row_number() over (order by {index}, id, text_crc32, size) - 1 place, count(*) over () total from s{step}),
        p as (select *, total // {count} each, (total % {count}) * (total // {count} + 1) wide from r),
        q as (select *, case when place < wide then place // (each + 1) else total % {count} + (place - wide) // greatest(1, each) end shard from p)
        select id doc_id, cast(size as bigint) size, cast(text_crc32 as bigint) text_crc32, 'rows' law, cast(shard as int) shard,
            cast(place - case when shard < total % {count} then shard * (each + 1) else wide + (shard - total % {count}) * each end as bigint) slot, cast(null as int) grown_shard, cast(curve as bigint) curve from q"""
