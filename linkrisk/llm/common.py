"""Words and Arrow batches, as the operators of this subpackage share them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

#: A word is a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows of an Arrow batch of texts, unless the session sets ``spark.sql.execution.arrow.maxRecordsPerBatch`` itself.
BATCH_ROWS = 1_000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_KEPT: dict[str, dict] = {}


def word_count(text: Column) -> Column:
    """Words of a text as a long; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def digest60(*parts: Column) -> Column:
    """The first 60 bits of the MD5 of the parts, joined by ``:``, as a non-negative long.

    MD5 is taken because other engines have it too and can check the result.
    """
    joined = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(joined), 1, 15), 16, 10).cast("long")


def with_fields(kept: DataFrame, more: str):
    """The schema of ``kept`` followed by the fields of a DDL text; names may hold any characters."""
    from pyspark.sql.types import StructType

    return StructType([*kept.schema.fields, *StructType.fromDDL(more).fields])


def own_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores in front until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    return ["_" * next(n for n in range(len(taken) + 1) if "_" * n + name.lower() not in taken) + name for name in names]


def modest_batches(df: DataFrame) -> DataFrame:
    """``df``, with Spark's 10,000 rows of an Arrow batch lowered to ``BATCH_ROWS`` in its session if nobody has set them.

    A batch of texts is held several times, by the executor and by Python; the number of its rows is what bounds it.
    """
    conf = df.sparkSession.conf
    if conf.get(_BATCH, None) is None:
        conf.set(_BATCH, BATCH_ROWS)
    return df


def remembered(operator: str) -> dict:
    """What this Python worker keeps between the tasks of an operator; what it has kept for another one is dropped."""
    for other in [o for o in _KEPT if o != operator]:
        del _KEPT[other]
    return _KEPT.setdefault(operator, {})


def beside_text(docs: DataFrame, text: str, keep: list[str]) -> tuple[DataFrame, Callable[[pa.RecordBatch], pa.Array]]:
    """``keep`` and the text, and how to get the text from a batch: a field of a kept struct does not travel twice."""
    outer, _, field = text.rpartition(".")
    modest_batches(docs)
    if outer in keep:
        place = list(keep).index(outer)
        return docs.select(*keep), lambda batch: batch.column(place).field(field)
    return docs.select(*keep, F.col(text).alias("_text")), lambda batch: batch.columns[-1]


def map_batches(df: DataFrame, function: Callable[[dict[str, list]], dict[str, list] | None], schema: str) -> DataFrame:
    """``function`` turns the columns of each Arrow batch, as lists, into columns of the result."""
    from pyspark.sql.types import StructType

    target = StructType.fromDDL(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(target)
        for batch in batches:
            if batch.num_rows:
                out = function({n: c.to_pylist() for n, c in zip(batch.schema.names, batch.columns)})
                if out is not None:
                    yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in arrow], schema=arrow)

    return modest_batches(df).mapInArrow(run, schema)


def by_size(batches: Iterator[pa.RecordBatch], column: str, most: int = 8_000_000) -> Iterator[pa.RecordBatch]:
    """The rows anew in batches of ``most`` bytes of the column or one row more, whatever they came in."""
    held, size = [], 0
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        lo = 0
        while lo < batch.num_rows:
            before = int(ends[lo - 1]) if lo else 0
            hi = min(batch.num_rows, int(np.searchsorted(ends, before + most - size)) + 1)
            held.append(batch.slice(lo, hi - lo))
            size += int(ends[hi - 1]) - before
            lo = hi
            if size >= most:
                yield pa.concat_batches(held)
                held, size = [], 0
    if held:
        yield pa.concat_batches(held)
