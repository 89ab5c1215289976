"""JSON collections as a data source: one document, an array of records or an object of entries, sorted by key.

``spark.read.format("json_collection")`` gives (key, value): a record's key and its JSON exactly as it stands in the file. Pretty
documents are read by byte ranges, since a line of two spaces can only begin a record. A compact document is one line: before a large one
is read, tasks count quotes and brackets range by range, and from these counts follows how deep, and whether in a string, each range begins.
A document is read a piece at a time. The writer's tasks each serialize a sorted range into a part; the commit strings the parts
together, a piece at a time, and puts the document in place by a rename. Whoever reads sees the old document or the new one; an
aborted job leaves the old one.
"""

from __future__ import annotations

import json
import posixpath
import re
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

from tilewright.sources.scratch import written
from tilewright.sources.shipping import shipped

PIECE = 1 << 20
#: Bytes of a pretty document that a task reads.
RANGE = 32 << 20
#: Bytes of a compact document that a task reads at least: smaller ones are one task's work.
COMPACT = 4 << 20
_NUMBER, _KEY = "a number of the collection is not finite", "a key of the collection is null"
_ESCAPE = re.compile(rb"\\.", re.S)
_PRETTY = re.compile(rb"[\[{]\n  (?=[^ \]}])")
_ENTRY = re.compile(rb'\s*("(?:[^"\\]|\\.)*")\s*:\s*', re.S)
_LINE = re.compile(rb"\n  (?=[^ \]}])")


def _filesystem(path: str):
    from pyarrow import fs

    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path)


def _pieces(file, start: int, size: int) -> Iterator[bytes]:
    file.seek(start)
    while size > 0 and (piece := file.read(min(PIECE, size))):
        size -= len(piece)
        yield piece


def _masked(pieces: Iterator[bytes], escaped: bool = False) -> Iterator[tuple[bytes, bytes]]:
    """Pieces, and the same with blanks for each backslash and what it escapes: all quotes that are left begin or end a string."""
    for piece in filter(None, pieces):
        masked = b" " + piece[1:] if escaped else piece
        masked = _ESCAPE.sub(b"  ", masked) if b"\\" in masked else masked
        escaped = masked.endswith(b"\\")
        yield piece, masked


#: What a byte is: a quote, an opening or closing bracket, a comma.
_QUOTE, _OPEN, _CLOSE, _COMMA = 1, 2, 3, 4
_KINDS = np.zeros(256, np.uint8)
for _byte, _kind in zip(b'"[{]},', (_QUOTE, _OPEN, _OPEN, _CLOSE, _CLOSE, _COMMA), strict=True):
    _KINDS[_byte] = _kind
_STEPS = np.array([0, 0, 1, -1, 0])


def records(pieces: Iterator[bytes], depth: int = 0, begin: int = -1, inside: bool = False, escaped: bool = False, end: int | None = None) -> Iterator[tuple[int, bytes]]:
    """(place, bytes) of the records of a document, from its beginning on; a place is where a bracket or comma has just ended.

    Pieces from elsewhere on are given with their ``depth``, whether they begin ``inside`` a string, and whether their first byte is
    ``escaped``; ``begin`` is 0 if they begin with a record. Places from ``end`` on, counted from the pieces' first byte, are not read.
    """
    left: list[bytes] = []
    base = 0
    for piece, masked in _masked(pieces, escaped):
        if end is not None and base >= end and begin < 0:
            return
        codes = _KINDS[np.frombuffer(masked, np.uint8)]
        at = np.flatnonzero(codes)
        kinds = codes[at]
        quotes = np.cumsum(kinds == _QUOTE) + inside
        outside = (quotes & 1 == 0) & (kinds != _QUOTE)
        inside = bool(quotes[-1] & 1) if len(quotes) else inside
        at, kinds = at[outside], kinds[outside]
        depths = depth + np.cumsum(_STEPS[kinds])
        depth = int(depths[-1]) if len(depths) else depth
        found = np.flatnonzero((depths == 1) & (kinds != _CLOSE) | (depths == 0) & (kinds == _CLOSE))
        for place, kind in zip(at[found].tolist(), kinds[found].tolist(), strict=True):
            if begin >= 0:
                record = (b"".join(left) + piece[max(begin - base, 0) : place]).strip()
                left = []
                if record:
                    yield begin, record
            if kind == _CLOSE:
                return
            begin = base + place + 1
            if end is not None and begin >= end:
                return
        if begin >= 0:
            left.append(piece[max(begin - base, 0) :])
        base += len(piece)
    if depth > 0 or inside:
        raise ValueError("the document ends within a record")


def counted(pieces: Iterator[bytes], escaped: bool) -> tuple[int, int, int]:
    """Opening less closing brackets of a range, if it begins outside of a string and if it begins inside, and its quotes modulo 2."""
    depths, odd = [0, 0], 0
    for _, masked in _masked(pieces, escaped):
        parts = masked.split(b'"')
        for i in (0, 1):
            text = b"".join(parts[i::2])
            depths[(i + odd) % 2] += text.count(b"[") + text.count(b"{") - text.count(b"]") - text.count(b"}")
        odd = (odd + len(parts) - 1) % 2
    return depths[0], depths[1], odd


def _escaped(file, start: int) -> bool:
    """Whether an odd number of backslashes stands before a place of a file."""
    n, size = 0, 64
    while start - n > 0:
        size = min(size * 2, PIECE, start - n)
        file.seek(start - n - size)
        piece = file.read(size)
        more = size - len(piece.rstrip(b"\\"))
        n += more
        if more < size:
            break
    return n % 2 == 1


def begins(counts: Iterable[tuple[int, int, int]]) -> list[int]:
    """How each of a document's ranges begins, from what ``counted`` gives for them in order: twice its depth, and 1 more inside a string."""
    out, depth, string = [], 0, 0
    for outside, inside, odd in counts:
        out.append(2 * depth + string)
        depth += inside if string else outside
        string ^= odd
    return out


_COUNTS = pa.schema([("name", pa.string()), *((c, pa.int64()) for c in ("start", "outside", "inside", "odd"))])


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``counted`` of each range (path, name, start, end)."""
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            with _filesystem(row["path"])[0].open_input_file(row["name"]) as file:
                escaped = _escaped(file, row["start"])
                numbers = counted(_pieces(file, row["start"], row["end"] - row["start"]), escaped)
            out.append({"name": row["name"], "start": row["start"]} | dict(zip(_COUNTS.names[2:], numbers, strict=True)))
        yield pa.RecordBatch.from_pylist(out, _COUNTS)


def _documents(path: str) -> list:
    """The files of a path: itself, or the ``.json`` documents below it."""
    from pyarrow import fs

    files, root = _filesystem(path)
    info = files.get_file_info(root)
    if info.type == fs.FileType.File:
        return [info]
    return sorted((f for f in files.get_file_info(fs.FileSelector(root, recursive=True)) if f.type == fs.FileType.File and f.path.endswith(".json")), key=lambda f: f.path)


def _pretty(files, path: str) -> bool:
    with files.open_input_stream(path) as head:
        return _PRETTY.match(head.read(5)) is not None


def _version(info) -> list[int]:
    return [info.size, info.mtime_ns or 0]


def _begins(spark: SparkSession, path: str, size: int) -> dict[str, dict]:
    """How the ranges of ``size`` bytes of the path's large compact documents begin. Tasks count; the driver adds up three numbers of each range."""
    files, _ = _filesystem(path)
    large = {f.path: f for f in _documents(path) if f.size > size and not _pretty(files, f.path)}
    ranges = [(path, f.path, a, min(a + size, f.size)) for f in large.values() for a in range(0, f.size, size)]
    if not ranges:
        return {}
    rows = spark.createDataFrame(ranges, "path string, name string, start long, end long").repartition(min(len(ranges), 1000))
    counts: dict[str, list] = {name: [] for name in large}
    for name, _, *numbers in sorted(tuple(r) for r in rows.mapInArrow(_counts, "name string, start long, outside long, inside long, odd long").collect()):
        counts[name].append(numbers)
    return {name: {"version": _version(f), "size": size, "begins": begins(counts[name])} for name, f in large.items()}


@dataclass
class _Range(InputPartition):
    path: str
    start: int
    end: int
    pretty: bool
    begins: int = 0
    version: list[int] | None = None


class _Reader(DataSourceReader):
    def __init__(self, path: str, id_field: str, size: int, begins: str) -> None:
        self.path, self.id_field, self.size, self.begins = path, id_field, size, begins

    def partitions(self) -> list[InputPartition]:
        files, _ = _filesystem(self.path)
        known = json.loads(self.begins)
        out: list[InputPartition] = []
        for f in _documents(self.path):
            if _pretty(files, f.path):
                out += [_Range(f.path, a, min(a + self.size, f.size), True) for a in range(0, f.size, self.size)]
            elif (has := known.get(f.path)) and has["version"] == _version(f):
                out += [_Range(f.path, i * has["size"], min((i + 1) * has["size"], f.size), False, b, has["version"]) for i, b in enumerate(has["begins"])]
            else:  # a small one, or one that nobody has counted
                out.append(_Range(f.path, 0, f.size, False))
        return out or [_Range("", 0, 0, False)]

    def _records(self, part: _Range) -> Iterator[bytes]:
        if not part.path:
            return
        files, _ = _filesystem(self.path)
        with files.open_input_file(part.path) as file:
            size = file.size()
            if part.version and part.version != _version(files.get_file_info(part.path)):
                raise ValueError("the document was replaced after its ranges had been counted: read it anew")
            if not part.pretty:
                # records whose bracket or comma stands in the range: places are one further
                escaped = _escaped(file, part.start)
                found = records(_pieces(file, part.start, size - part.start), part.begins // 2, -1, part.begins % 2 == 1, escaped, part.end - part.start + 1)
                yield from (record for _, record in found)
                return
            # records whose line break stands in the range, from the first one on
            held, first = b"", -1
            for piece in _pieces(file, part.start, size - part.start):
                held += piece
                if found := _LINE.search(held):
                    first = found.end()
                if first >= 0 or len(held) > part.end - part.start + 3:
                    break
            if first < 0 or part.start + first - 3 >= part.end:
                return
            first += part.start
            yield from (record for _, record in records(_pieces(file, first, size - first), 1, 0, end=max(part.end - first, 1)))

    def read(self, part: _Range):
        for record in self._records(part):
            entry = _ENTRY.match(record) if record[:1] == b'"' else None
            if entry:
                yield json.loads(entry[1]), record[entry.end() :].decode()
            else:
                text = record.decode()
                value = json.loads(text)
                yield (str(value[self.id_field]) if isinstance(value, dict) and value.get(self.id_field) is not None else None), text


@dataclass
class _Part(WriterCommitMessage):
    path: str
    number: int
    records: int


def _refuse(name: str):
    raise ValueError(f"{name} is no number that JSON has")


class _Writer(DataSourceWriter):
    def __init__(self, path: str, layout: str, pretty: bool, overwrite: bool) -> None:
        self.path, self.layout, self.pretty, self.overwrite = path, layout, pretty, overwrite
        self.parts = f"{path.rstrip('/')}.parts-{uuid.uuid4().hex}"

    def _text(self, key: str | None, value: str) -> str:
        data = json.loads(value, parse_constant=_refuse)
        how = {"indent": 2} if self.pretty else {"separators": (",", ":")}
        text = json.dumps(data, allow_nan=False, **how)
        if self.layout == "map":
            text = json.dumps(key) + (": " if self.pretty else ":") + text
        return text.replace("\n", "\n  ") if self.pretty else text

    def write(self, rows) -> WriterCommitMessage:
        context = TaskContext.get()
        files, root = _filesystem(self.parts)
        files.create_dir(root)
        name = posixpath.join(root, f"{context.partitionId():08d}-{context.taskAttemptId()}")
        between, n = ",\n  " if self.pretty else ",", 0
        with files.open_output_stream(name) as out:
            for row in rows:
                out.write(((between if n else "") + self._text(row[0], row[1])).encode())
                n += 1
        return _Part(name, context.partitionId(), n)

    def commit(self, messages) -> None:
        files, root = _filesystem(self.parts)
        files.create_dir(root)
        left, right = "{}" if self.layout == "map" else "[]"
        between = ",\n  " if self.pretty else ","
        whole, some = posixpath.join(root, "document"), False
        with files.open_output_stream(whole) as out:
            out.write(left.encode())
            for part in sorted((m for m in messages if m is not None and m.records), key=lambda m: m.number):
                out.write((between if some else "\n  " if self.pretty else "").encode())
                some = True
                with files.open_input_file(part.path) as file:
                    for piece in _pieces(file, 0, file.size()):
                        out.write(piece)
            out.write((("\n" if self.pretty and some else "") + right).encode())
        target = _filesystem(self.path)[1]
        files.move(whole, target)
        files.delete_dir(root)

    def abort(self, messages) -> None:
        from pyarrow import fs

        files, root = _filesystem(self.parts)
        if files.get_file_info(root).type == fs.FileType.Directory:
            files.delete_dir(root)


class JsonCollection(DataSource):
    """Options: ``id`` (the field of a record's key), ``layout`` (array or map), ``pretty`` (true or false), ``rangeBytes``."""

    @classmethod
    def name(cls) -> str:
        return "json_collection"

    def schema(self) -> str:
        return "key string, value string"

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _Reader(self.options["path"], self.options.get("id", "id"), int(self.options.get("rangeBytes", RANGE)), self.options.get("begins", "{}"))

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceWriter:
        return _Writer(self.options["path"], self.options.get("layout", "array"), self.options.get("pretty", "false") == "true", overwrite)


def not_finite(value: Column, kind: T.DataType) -> Column | None:
    """Whether a value holds NaN or an infinity at any depth of structs, arrays and maps; None where its type has no such numbers."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.isnan(value) | (F.abs(value) == float("inf"))
    found: list[Column] = []
    if isinstance(kind, T.StructType):
        found = [x for f in kind if (x := not_finite(value[f.name], f.dataType)) is not None]
    elif isinstance(kind, T.ArrayType) and not_finite(F.lit(None), kind.elementType) is not None:
        found = [F.exists(value, lambda v: F.coalesce(not_finite(v, kind.elementType), F.lit(False)))]
    elif isinstance(kind, T.MapType) and not_finite(F.lit(None), kind.valueType) is not None:
        found = [F.exists(F.map_values(value), lambda v: F.coalesce(not_finite(v, kind.valueType), F.lit(False)))]
    if not found:
        return None
    out = F.lit(False)
    for x in found:
        out |= F.coalesce(x, F.lit(False))
    return out


def registered(spark: SparkSession) -> SparkSession:
    spark.dataSource.register(JsonCollection)
    return shipped(spark)


def write_collection(df: DataFrame, path: str, key: str, layout: str = "array", pretty: bool = False, value: str | None = None) -> None:
    """One document of the rows of ``df``, ascending by ``key``: an array of records, or with ``layout`` "map" an object of ``value`` by key.

    Null fields are written as null. A number that is not finite, at any depth, or a null key stops the job: the document that was
    there stays. No rows give an empty array or object.
    """
    whole = F.col(value) if value else F.struct(*df.columns)
    bad = not_finite(whole, df.schema[value].dataType if value else df.schema)
    text = F.to_json(whole, {"ignoreNullFields": "false"})
    if bad is not None:
        text = F.when(bad, F.raise_error(F.lit(_NUMBER)).cast("string")).otherwise(text)
    named = F.when(F.col(key).isNull(), F.raise_error(F.lit(_KEY)).cast("string")).otherwise(F.col(key).cast("string"))
    rows = df.repartitionByRange(key).sortWithinPartitions(key).select(named.alias("key"), F.coalesce(text, F.lit("null")).alias("value"))
    try:
        _save(rows, path, layout, pretty)
    except PySparkException as e:
        for why in (_NUMBER, _KEY):
            if why in str(e):
                raise ValueError(why) from e
        raise


def _save(rows: DataFrame, path: str, layout: str, pretty: bool) -> None:
    registered(rows.sparkSession)
    rows.write.format("json_collection").mode("append").option("layout", layout).option("pretty", str(pretty).lower()).save(path)


def copy_collection(entries: DataFrame, path: str, layout: str = "array", pretty: bool = False) -> None:
    """One document of (key, value) rows as ``read_collection`` gives them, ascending by key; they are read once."""
    held = written(entries.select("key", "value"), "entries")  # ranges are chosen in one pass over the rows and dealt in another
    _save(held.repartitionByRange("key").sortWithinPartitions("key"), path, layout, pretty)


def read_collection(spark: SparkSession, path: str, id_field: str = "id", range_bytes: int = RANGE) -> DataFrame:
    """(key, value) of a document, or of all ``.json`` documents below a folder; ``value`` is the record's JSON as it stands there.

    Compact documents larger than ``range_bytes`` (and than ``COMPACT``) are counted by a job first, so that they too are read by ranges.
    """
    known = _begins(registered(spark), path, max(range_bytes, COMPACT))
    return spark.read.format("json_collection").option("id", id_field).option("rangeBytes", range_bytes).option("begins", json.dumps(known)).load(path)
