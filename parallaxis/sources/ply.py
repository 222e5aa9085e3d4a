"""Point clouds in PLY files: header-declared properties, fixed stride, split by row ranges."""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parallaxis.sources.records import FormatError

#: Names of scalar types in headers, their numpy kind, and the Spark type that holds them.
KINDS = {
    "char": ("i1", T.ByteType()), "int8": ("i1", T.ByteType()), "uchar": ("u1", T.ShortType()), "uint8": ("u1", T.ShortType()),
    "short": ("i2", T.ShortType()), "int16": ("i2", T.ShortType()), "ushort": ("u2", T.IntegerType()), "uint16": ("u2", T.IntegerType()),
    "int": ("i4", T.IntegerType()), "int32": ("i4", T.IntegerType()), "uint": ("u4", T.LongType()), "uint32": ("u4", T.LongType()),
    "float": ("f4", T.FloatType()), "float32": ("f4", T.FloatType()), "double": ("f8", T.DoubleType()), "float64": ("f8", T.DoubleType()),
}
ORDERS = {"binary_little_endian": "<", "binary_big_endian": ">", "ascii": ""}
CHUNK = 1 << 16


def parse_header(data: bytes, path: str) -> dict:
    """Format, rows, properties ``[(name, type)]``, comments and body offset of a cloud."""
    end = data.find(b"end_header\n")
    shift = len(b"end_header\n")
    if end < 0:
        end = data.find(b"end_header\r\n")
        shift += 1
    if not data.startswith(b"ply") or end < 0:
        raise FormatError(f"{path}: not a PLY file")
    form, comments, elements = None, [], []
    for line in data[:end].decode("ascii", "replace").splitlines()[1:]:
        word = line.split()
        if not word:
            continue
        if word[0] == "format":
            if word[1] not in ORDERS:
                raise FormatError(f"{path}: unknown format {word[1]}")
            form = word[1]
        elif word[0] in ("comment", "obj_info"):
            comments.append(line.partition(" ")[2])
        elif word[0] == "element":
            elements.append((word[1], int(word[2]), []))
        elif word[0] == "property":
            if word[1] == "list":
                if elements[-1][0] == "vertex" or len(elements) == 1:
                    raise FormatError(f"{path}: list property {word[-1]}")
                continue
            if word[1] not in KINDS or not elements:
                raise FormatError(f"{path}: unknown property type {word[1]}")
            elements[-1][2].append((word[2], word[1]))
    if form is None or not elements:
        raise FormatError(f"{path}: header without format or element")
    named = [k for k, e in enumerate(elements) if e[0] == "vertex"]
    if named and named[0]:
        raise FormatError(f"{path}: vertex is not the first element")
    _, rows, properties = elements[0]
    if not {"x", "y", "z"} <= {n for n, _ in properties}:
        raise FormatError(f"{path}: no positions")
    return {"format": form, "rows": rows, "properties": properties, "comments": comments, "offset": end + shift}


def spark_schema(properties) -> T.StructType:
    """One field a property; the declared type is kept as metadata for writers."""
    return T.StructType([T.StructField(n, KINDS[k][1], True, {"ply": KINDS[k][0]}) for n, k in properties])


def read_header(path: str) -> dict:
    """The header of a cloud file (see ``parse_header``)."""
    with open(path.removeprefix("file://"), "rb") as f:
        return parse_header(f.read(1 << 20), path)


def read_ply(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a cloud, file order in ``_row`` dropped by selecting; splits are row ranges of fixed stride.

    The header is read on the driver; bodies of fixed stride are read by
    range in every task, from a path that all executors see. ASCII bodies are
    one task's.
    """
    local = path.removeprefix("file://")
    head = read_header(path)
    kinds = np.dtype([(n, ORDERS[head["format"]] + KINDS[k][0]) for n, k in head["properties"]])
    fields = spark_schema(head["properties"])
    ascii_ = head["format"] == "ascii"
    if not ascii_ and os.path.getsize(local) < head["offset"] + head["rows"] * kinds.itemsize:
        raise FormatError(f"{path}: truncated: {head['rows']} rows declared")
    names = [n for n, _ in head["properties"]]
    from pyspark.sql.pandas.types import to_arrow_type

    arrow = [to_arrow_type(f.dataType) for f in fields]

    def run(batches):
        for batch in batches:
            for start in batch.column("id").to_pylist():
                n = head["rows"] if ascii_ else min(CHUNK, head["rows"] - start)
                with open(local, "rb") as f:
                    f.seek(head["offset"])
                    if ascii_:
                        lines = [x.split() for x in f.read().decode("ascii").splitlines() if x.strip()][:n]
                        if len(lines) < n or any(len(x) < len(names) for x in lines):
                            raise FormatError(f"{path}: truncated: {n} rows declared")
                        rows = np.array([tuple(float(v) if t[0] == "f" else int(float(v)) for v, t in zip(x, [KINDS[k][0] for _, k in head["properties"]], strict=False)) for x in lines], np.dtype([(a, KINDS[k][0]) for a, k in head["properties"]]))
                    else:
                        f.seek(start * kinds.itemsize, 1)
                        rows = np.frombuffer(f.read(n * kinds.itemsize), kinds)
                columns = [pa.array(np.ascontiguousarray(rows[c]).astype(rows[c].dtype.newbyteorder("="))).cast(k) for c, k in zip(names, arrow, strict=True)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(np.arange(start, start + len(rows)))], names=[*names, "_row"])

    starts = spark.range(0, 1 if ascii_ else max(head["rows"], 1), head["rows"] + 1 if ascii_ else CHUNK)
    ddl = T.StructType([*fields, T.StructField("_row", T.LongType())])
    out = starts.mapInArrow(run, ddl).drop("_row") if head["rows"] else spark.createDataFrame([], fields)
    return out.select(*[F.col(f.name).alias(f.name, metadata=f.metadata) for f in fields])


def write_ply(cloud: DataFrame, path: str, comments: list[str] = ()) -> int:
    """A little-endian cloud with the properties, types and row order of ``cloud``; returns the rows written."""
    back = {"byte": "i1", "short": "i2", "int": "i4", "long": "i4", "float": "f4", "double": "f8"}
    declared = {"i1": "char", "u1": "uchar", "i2": "short", "u2": "ushort", "i4": "int", "u4": "uint", "f4": "float", "f8": "double"}
    kinds = [(f.name, f.metadata.get("ply") or back[f.dataType.typeName().replace("integer", "int")]) for f in cloud.schema]
    row = np.dtype([(n, "<" + k) for n, k in kinds])

    def pack(batches):
        for batch in batches:
            rows = np.zeros(len(batch), row)
            for n, _ in kinds:
                rows[n] = batch.column(n).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([pa.array([rows.tobytes()], pa.binary())], names=["body"])

    total = cloud.count()
    with open(path, "wb") as out:
        lines = ["ply", "format binary_little_endian 1.0", *[f"comment {c}" for c in comments], f"element vertex {total}", *[f"property {declared[k]} {n}" for n, k in kinds], "end_header"]
        out.write(("\n".join(lines) + "\n").encode("ascii"))
        for r in cloud.mapInArrow(pack, "body binary").toLocalIterator():
            out.write(r["body"])
    return total
