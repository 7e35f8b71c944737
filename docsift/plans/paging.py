"""Sort orders and pages."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsift.plans.predicates import Fields, pair_key
from docsift.schema import DEFAULT_MAPPING, DOCID, PROPS, FieldMapping
from docsift.session import materialize

# Rows before a page up to which they may meet in one task.
DEEP_ROWS = 100_000


@dataclass(frozen=True)
class Page:
    """What part of a result is wanted, and in which order.

    `sort` is a comma list such as `"name:asc,timestamp:desc"`; a field without a direction
    follows `desc`. A `last_key` of `(docid, id)` continues behind that row.
    """

    number: int = 1
    limit: int = 30
    sort: str = ""
    desc: bool = True
    last_key: tuple[int, str] | None = None
    max_pages: int | None = None

    def offset(self) -> int:
        out = self.number < 1 or (self.max_pages is not None and self.number > self.max_pages)
        return 0 if out else (self.number - 1) * self.limit


def _directed(value: Column, desc: bool) -> Column:
    return value.desc_nulls_last() if desc else value.asc_nulls_last()


def _sort_value(fields: Fields, name: str, desc: bool) -> Column:
    if not fields.is_pair(name):
        return fields.column(name)
    typed = "kt" in fields.schema[PROPS].dataType.elementType.fieldNames()
    numbers = F.transform(F.filter(fields.pairs(), lambda p: pair_key(p, name, typed)),
                          lambda p: p["vn"])
    return F.array_max(numbers) if desc else F.array_min(numbers)


def sort_columns(df: DataFrame, page: Page, mapping: FieldMapping = DEFAULT_MAPPING,
                 score: str = "score", tie: str = "id") -> list[Column]:
    """Missing values come last in both directions, and `id` decides between equals."""
    fields, out, named = Fields(df.schema, mapping), [], set()
    for part in filter(None, (p.strip() for p in page.sort.split(","))):
        name, _, word = part.partition(":")
        desc = {"asc": False, "desc": True}.get(word.strip(), page.desc)
        out.append(_directed(_sort_value(fields, name.strip(), desc), desc))
        named.add(name.strip())
    if not out and score in df.columns:
        out.append(F.col(score).desc())
    if tie in df.columns and tie not in named:
        out.append(F.col(tie).asc())
    return out


def _with_values(df: DataFrame, page: Page, mapping: FieldMapping) -> tuple[DataFrame, Page]:
    """The rows with the values of the properties that they are sorted by, and the page that names these columns. An
    expression in a sort order would be evaluated at each comparison."""
    fields, values, order = Fields(df.schema, mapping), {}, []
    for part in filter(None, (p.strip() for p in page.sort.split(","))):
        name, _, word = part.partition(":")
        desc = {"asc": False, "desc": True}.get(word.strip(), page.desc)
        if fields.is_pair(name.strip()):
            values[f"_value{len(values)}"] = _sort_value(fields, name.strip(), desc)
            name = list(values)[-1]
        order.append(f"{name.strip()}:{'desc' if desc else 'asc'}")
    return (df.withColumns(values), replace(page, sort=", ".join(order))) if values else (df, page)


def take_page(df: DataFrame, page: Page, mapping: FieldMapping = DEFAULT_MAPPING,
              tie: str = "id") -> DataFrame:
    """The rows of one page, in order: a top-k per partition, never a full sort. A page behind more than `DEEP_ROWS` rows
    is found by ranks, see `deep_page`."""
    if page.number <= 1 and page.last_key is not None:
        docid, last = page.last_key
        if page.desc:
            past = (F.col(DOCID) <= docid) & ((F.col(DOCID) < docid) | (F.col(tie) < last))
            order = [F.col(DOCID).desc(), F.col(tie).desc()]
        else:
            past = (F.col(DOCID) >= docid) & ((F.col(DOCID) > docid) | (F.col(tie) > last))
            order = [F.col(DOCID).asc(), F.col(tie).asc()]
        return df.filter(past).orderBy(*order).limit(page.limit)
    if page.offset() >= DEEP_ROWS:
        return deep_page(df, page, mapping, tie)
    valued, by_value = _with_values(df, page, mapping)
    ordered = valued.orderBy(*sort_columns(valued, by_value, mapping, tie=tie))
    if page.offset():
        ordered = ordered.offset(page.offset())
    return ordered.limit(page.limit).select(*[F.col(f"`{c}`") for c in df.columns])


def deep_page(df: DataFrame, page: Page, mapping: FieldMapping = DEFAULT_MAPPING, tie: str = "id",
              parts: int | None = None) -> DataFrame:
    """The rows of a page far behind, in order, without bringing all rows before it to one task.

    The rows are dealt to ranges of the sort order and written to the shared folder; the counts per range say in which
    the page lies, and only those are sorted. Select the columns that are needed first: they are what is
    written. By default there are four ranges for each shuffle partition.
    """
    spark = df.sparkSession
    order = sort_columns(df, page, mapping, tie=tie)
    parts = parts or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = materialize(df.repartitionByRange(parts, *order).withColumn("_range", F.spark_partition_id()), "ranges")
    begin, end, before, chosen = page.offset(), page.offset() + page.limit, 0, []
    # a row per range
    for r in sorted(rows.groupBy("_range").agg(F.count(F.lit(1)).alias("n")).collect()):
        if before + r["n"] <= begin:
            before += r["n"]
        elif not chosen or chosen[-1][1] < end:
            chosen.append((r["_range"], (chosen[-1][1] if chosen else before) + r["n"]))
    near = rows.filter(F.col("_range").isin([c for c, _ in chosen])).drop("_range")
    return near.orderBy(*sort_columns(near, page, mapping, tie=tie)).offset(begin - before).limit(page.limit)


def last_key(page_rows: DataFrame, desc: bool = True, tie: str = "id") -> tuple[int, str] | None:
    """Where the next keyset page starts; the input is one page, so this brings back one row."""
    pair = F.struct(F.col(DOCID).alias("d"), F.col(tie).alias("i"))
    row = page_rows.agg((F.min(pair) if desc else F.max(pair)).alias("last")).first()
    return None if row is None or row["last"] is None else (row["last"]["d"], row["last"]["i"])
