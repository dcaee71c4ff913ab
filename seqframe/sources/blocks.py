"""Evenly spaced blocks of large CSV files, without reading what lies between them.

A Python data source: every block is a partition that opens the files itself and reads its byte range, so the bytes
read depend on the blocks asked for and not on the size of the files. A range begins anywhere, perhaps inside a
quoted cell; both readings are tried, and the one under which more records have the right number of cells counts.
"""

from __future__ import annotations

import csv
import io
import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not have the package

#: Columns that come before those of the file.
PLACE = ("block", "block_start")


class Files:
    """The files of a path, one after the other by name, as one range of bytes."""

    def __init__(self, path: str):
        from pyarrow import fs

        if "://" not in path and not path.startswith("file:"):
            self.store, place = fs.LocalFileSystem(), path
        else:
            self.store, place = fs.FileSystem.from_uri(path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file://") else path)
        found = self.store.get_file_info(place)
        listed = [found] if found.is_file else self.store.get_file_info(fs.FileSelector(place))
        named = [f for f in listed if f.is_file and not f.base_name.startswith(("_", "."))]
        self.files = sorted(((f.path, f.size) for f in named), key=lambda f: f[0])
        self.size = sum(n for _, n in self.files)

    def read(self, start: int, end: int) -> bytes:
        parts, before = [], 0
        for path, size in self.files:
            low, high = max(start - before, 0), min(end - before, size)
            if low < high:
                with self.store.open_input_file(path) as file:
                    file.seek(low)
                    parts.append(file.read(high - low))
            before += size
        return b"".join(parts)


def records(raw: bytes, quoted: bool) -> Iterator[tuple[int, int]]:
    """(begin, end) of the whole records in a range, read as beginning inside or outside a quoted cell.

    Records end at line feeds outside quotes: where the number of quotes so far is even.
    """
    first, parity, at = None, int(quoted), 0
    while (line := raw.find(b"\n", at)) >= 0:
        parity = (parity + raw.count(b'"', at, line)) % 2
        at = line + 1
        if not parity:
            if first is not None:
                yield first, at
            first = at


def cells(raw: bytes) -> list[str]:
    return next(csv.reader(io.StringIO(raw.decode("utf-8", "replace"), newline="")), [])


class StridedReader(DataSourceReader):
    def __init__(self, options: dict[str, str], names: list[str]):
        self.path, self.names = options["path"], names
        self.blocks, self.bytes = int(options.get("blocks", 8)), int(options.get("block_bytes", 1 << 20))

    def partitions(self) -> list[InputPartition]:
        """Blocks begin at i * size / (blocks + 1), rounded down, for i = 1 … blocks."""
        size = Files(self.path).size
        return [InputPartition((i, i * size // (self.blocks + 1))) for i in range(1, self.blocks + 1)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        block, start = partition.value
        files = Files(self.path)
        # One byte earlier: if it ends a record, the range begins with one.
        low = max(start - 1, 0)
        raw = files.read(low, start + self.bytes)
        if not start:
            raw = b"\n" + raw
        readings = []
        for quoted in (False, True):
            rows = [cells(raw[a:b]) for a, b in records(raw, quoted)]
            good = [r for r in rows if len(r) == len(self.names)]
            readings.append((len(good) - (len(rows) - len(good)), not quoted, good))
        for row in max(readings)[2]:
            if row != self.names:  # a header line of a file
                yield (block, start, *row)


class StridedCsv(DataSource):
    """``path``; ``blocks`` and ``block_bytes``; ``columns``, comma-separated, for files without a header line."""

    @classmethod
    def name(cls) -> str:
        return "strided_csv"

    def _names(self) -> list[str]:
        if self.options.get("columns"):
            return self.options["columns"].split(",")
        files = Files(self.options["path"])
        return cells(files.read(0, 1 << 20).split(b"\n", 1)[0])

    def schema(self) -> StructType:
        place = [StructField(PLACE[0], IntegerType()), StructField(PLACE[1], LongType())]
        return StructType(place + [StructField(n, StringType()) for n in self._names()])

    def reader(self, schema: StructType) -> StridedReader:
        return StridedReader(dict(self.options), [f.name for f in schema.fields[len(PLACE):]])


def read_strided_blocks(
    spark: SparkSession, path: str, blocks: int = 8, block_bytes: int = 1 << 20, columns: list[str] | None = None
) -> DataFrame:
    """``(block, block_start, cells…)`` of the whole records inside each block, every cell as text.

    Records with another number of cells than the header are left out. Blocks that overlap repeat the shared records.
    """
    spark.dataSource.register(StridedCsv)
    reader = spark.read.format("strided_csv").option("blocks", blocks).option("block_bytes", block_bytes)
    return (reader.option("columns", ",".join(columns)) if columns else reader).load(path)
