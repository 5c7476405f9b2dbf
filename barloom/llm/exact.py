"""Exact duplicate removal by a distributed radix partition on successive bytes.

Every round cuts the next bytes off each text that is still undecided and splits its group by
them. A group of one is decided; so is a group whose texts all ended. The first round reads 64
bytes, each later one eight times as many as the one before, so the number of rounds is the
logarithm of the longest text that has a copy, and texts without a copy rarely get beyond the
first. Equality is equality of bytes; no digest takes part.

Groups are counted by a hash aggregate that reduces on the map side, then joined back. A hot
group is therefore one row per task in the count, and in the join the rows of a hot group may
be split over tasks at run time since the counted side is one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import fresh_name, row_order, text_or_empty, written

FIRST_BYTES, GROWTH = 64, 8
WHITE_SPACE = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """The text with every run of ASCII white space replaced by one space; null is empty."""
    return F.regexp_replace(text_or_empty(text), WHITE_SPACE, " ")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """All columns of ``docs`` with ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    * Null texts count as empty, and empty texts equal each other.
    * Of equal texts the row with the smallest id stays; a null id comes last; of rows that
      repeat the same id, one stays. ``keep_id`` is null only if all ids of the group are.
    * An empty table gives an empty result; other columns of any name pass through. The text
      column itself is returned only with ``with_text``; else it is null.
    * Columns of ``docs`` named like a result column are replaced.
    """
    result = ["keep_id", "group_size", "kept", "text_sha256"]
    docs = docs.drop(*[c for c in docs.columns if c.lower() in result])
    key, gid, seg, ended, done, size, least, low = fresh_name(
        docs, "key_", "gid_", "seg_", "ended_", "done_", "size_", "least_", "low_"
    )
    columns = docs.columns
    state = docs.withColumn(key, row_order(F.col(id_col), F.monotonically_increasing_id()))
    whole = normalised(F.col(text_col))
    state = state.withColumn("text_sha256", F.sha2(whole, 256)).withColumn(gid, F.lit(None).cast("decimal(38,0)"))

    start, width, finished = 0, FIRST_BYTES, []
    while True:
        data = whole.cast("binary")
        cut = state.withColumn(seg, F.substring(data, start + 1, width)).withColumn(
            ended, F.length(data) <= start + width
        )
        by = [seg, ended] if not start else [gid, seg, ended]
        groups = cut.groupBy(*by).agg(
            F.count(F.lit(1)).alias(size), F.min(key).alias(least), F.min(id_col).alias(low)
        )
        joined = cut.drop(*([gid] if not start else [])).join(groups, by, "left")
        resolved = F.col(ended) | (F.col(size) == 1)
        text = F.col(text_col) if with_text else F.when(~resolved, F.col(text_col))
        table = written(
            joined.select(
                *[c for c in columns if c != text_col],
                text.alias(text_col),
                "text_sha256",
                key,
                F.col(least).alias(gid),
                resolved.alias(done),
                F.when(resolved, F.col(low)).alias("keep_id"),
                F.when(resolved, F.col(size)).alias("group_size"),
                F.when(resolved, F.col(key) == F.col(least)).alias("kept"),
            ),
            f"radix-{start}",
        )
        finished.append(table.filter(done).select(*columns, *result))
        state = table.filter(~F.col(done)).select(*columns, "text_sha256", key, gid)
        if state.isEmpty():
            break
        start, width = start + width, width * GROWTH
    out = finished[0]
    for part in finished[1:]:
        out = out.union(part)
    return out


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose text equals that of a row that stays."""
    return exact_groups(docs, id_col, text_col, with_text=True).filter("kept").select(*docs.columns)
