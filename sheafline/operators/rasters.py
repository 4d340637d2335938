"""Pictures given as grey rasters: their panels, inked shares and comparable vectors, as rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from sheafline.functions.geometry import ink_share, normalise_raster, panels


def picture_parts(df: DataFrame, id: str = "id", least: int = 60, side: int = 32) -> DataFrame:
    """(id, kind, x0, y0, x1, y1, ink, vec) of each picture as a whole and of its panels of ``least`` pixels a side.

    ``df`` has the id, width, height and gray, the bytes of the raster row by row. ``ink`` is the
    share of dark pixels, ``vec`` the inked box fitted into a square. Rasters of another length than
    width times height, and nulls, give no rows.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, out = [], []
            for i, (w, h, gray) in enumerate(zip(*(b.column(k).to_pylist() for k in (1, 2, 3)))):
                if not gray or not w or not h or len(gray) != w * h:
                    continue
                page = np.frombuffer(gray, np.uint8).reshape(h, w)
                boxes = [("whole", (0, 0, w, h))] + [(f"panel{k}", x) for k, x in enumerate(panels(page)) if min(x[2] - x[0], x[3] - x[1]) >= least]
                for kind, box in boxes:
                    part = page[box[1] : box[3], box[0] : box[2]]
                    at.append(i)
                    out.append({"kind": kind, **dict(zip(("x0", "y0", "x1", "y1"), map(int, box))), "ink": ink_share(page, box), "vec": normalise_raster(part, side).ravel().tolist()})
            if out:
                table = pa.Table.from_pylist(out, pa.schema([("kind", pa.string()), *((c, pa.int64()) for c in ("x0", "y0", "x1", "y1")), ("ink", pa.float64()), ("vec", pa.list_(pa.float32()))])).combine_chunks()
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at)), *(c.chunk(0) for c in table.columns)], names=["id", *table.column_names])

    slim = df.select(F.col(id).alias("id"), F.col("width").cast("int").alias("width"), F.col("height").cast("int").alias("height"), "gray")
    schema = T.StructType([T.StructField("id", slim.schema["id"].dataType), *T._parse_datatype_string("kind string, x0 long, y0 long, x1 long, y1 long, ink double, vec array<float>").fields])
    return slim.mapInArrow(rows, schema).withColumnRenamed("id", id)


def triage(df: DataFrame, panels: str = "panels", labels: str = "labels") -> DataFrame:
    """The pictures with two panels or more, or any label: most panels first, fewest labels among equals."""
    return df.where((F.col(panels) >= 2) | (F.col(labels) > 0)).orderBy(F.desc(panels), labels)
