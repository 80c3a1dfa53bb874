"""Readers as a table function of SQL.

    register_units(spark)
    SELECT d.path, u.* FROM documents d, LATERAL read_units('html', d.path, d.content) u

The first argument names a parser reader (of :mod:`.trees`, or one registered)
and must be a constant, as the columns depend on it: readers of lines give
``start_line`` and ``end_line``, readers of trees ``node`` and ``line``, and
registered ones, which may give any locator, all of these and the locator's kind.
``content`` is text or bytes.  A document that does not parse, or whose reader
fails, gives one row that says so and has no text; null content gives no row.
Readers that are column expressions need no function: see :mod:`.native`.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.functions import AnalyzeArgument, AnalyzeResult, udtf
from pyspark.sql.types import BinaryType, BooleanType, LongType, MapType, StringType, StructType

from .extract import READERS, read_one
from .trees import TREES

NAME = "read_units"
BY_LINES = ("html",)
_LINES = [("start_line", "start"), ("end_line", "end")]
_NODES = [("node", "path"), ("line", "line")]


def register_units(spark: SparkSession, name: str = NAME) -> None:
    """Registers the function with the readers known now."""
    extra = {r.name: r for r in READERS if r.read is not None}

    def places(reader: str) -> list[tuple[str, str]]:
        """(column, field of the locator) of a reader."""
        if reader in extra:
            return [("kind", "kind"), *_LINES, *_NODES]
        return _LINES if reader in BY_LINES else _NODES

    class ReadUnits:
        @staticmethod
        def analyze(reader: AnalyzeArgument, path: AnalyzeArgument, content: AnalyzeArgument) -> AnalyzeResult:
            if reader.value not in TREES and reader.value not in extra:
                raise ValueError(f"the first argument must be a constant, one of {sorted({*TREES, *extra})}")
            if not isinstance(content.dataType, (StringType, BinaryType)):
                raise ValueError(f"content must be text or bytes, not {content.dataType.simpleString()}")
            schema = StructType().add("ordinal", LongType()).add("status", StringType()).add("detail", StringType())
            for column, _ in places(reader.value):
                schema = schema.add(column, StringType() if column in ("kind", "node") else LongType())
            return AnalyzeResult(schema.add("text", StringType()).add("verbatim", BooleanType()).add("meta", MapType(StringType(), StringType())))

        def eval(self, reader: str, path: str, content):
            if content is None:
                return
            fields = [field for _, field in places(reader)]
            data = content.encode() if isinstance(content, str) else bytes(content)
            status, _, detail, units = read_one(reader, path or "", data, extra)
            if units is None:
                yield (0, status, detail, *(None for _ in fields), None, None, None)
            for i, u in enumerate(units or []):
                yield (i, status, detail, *(u["locator"].get(f) for f in fields), u["text"], u["verbatim"], dict(u["meta"]))

    spark.udtf.register(name, udtf(ReadUnits))
