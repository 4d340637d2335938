"""Schemas and fixed vocabularies of the item archive."""

from __future__ import annotations

from pyspark.sql import types as T

#: The fields of an item in their order; the first ten are its metadata.
FIELDS = ("number", "paperName", "typeId", "type", "chapter", "point", "method", "score", "degree", "duplicateId", "body", "answer", "memo")
META = FIELDS[:10]
KEY = ("year", "region", "number")
#: Kinds of items with options, by id and by name.
CHOICE_IDS = (1, 2)
CHOICE_NAMES = ("单选", "多选", "选择")
#: Statuses of papers and of ledger rows, and the order of the ledger's sections, the resolved last.
PROGRESS = ("未开始", "材料就绪", "制作中", "已编译", "已自查", "待复核", "已完成", "回忆版")
LEDGER = ("待处理", "处理中", "已解决", "待人工核验", "待补充")
SECTIONS = (("待补充",), ("待处理", "处理中"), ("待人工核验",), ("已解决",))
LEDGER_ORDER = tuple(s for section in SECTIONS for s in section)
CATEGORIES = ("缺题", "缺图", "缺详解", "详解", "来源", "公式", "单位", "文字", "答案", "元数据", "图片编号", "复合图", "理综", "回忆版", "平台数据", "其它")

_LONGS = {"number", "typeId", "score", "degree", "duplicateId"}
ITEM = T.StructType([T.StructField(f, T.LongType() if f in _LONGS else T.StringType()) for f in FIELDS])
PAPER_JSON = T.StructType([T.StructField("items", T.ArrayType(ITEM))])
FINDING = T.StructType([T.StructField(f, T.LongType() if f in ("number", "line") else T.StringType()) for f in ("check", "level", "year", "region", "number", "line", "message")])
MANIFEST = T.StructType(
    [
        T.StructField("source_pdf", T.StringType()),
        T.StructField("source_pdf_sha256", T.StringType()),
        T.StructField("engine", T.StringType()),
        T.StructField("extracted_at", T.StringType()),
        T.StructField("count", T.LongType()),
        T.StructField("images", T.ArrayType(T.StructType([T.StructField("file", T.StringType()), T.StructField("page", T.LongType()), T.StructField("width", T.LongType()), T.StructField("height", T.LongType()), T.StructField("sha256", T.StringType())]))),
    ]
)
