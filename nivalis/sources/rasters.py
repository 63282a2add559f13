"""Binary grid sources: flat int16 grids, gzip members, zip members, daily tar archives.

Files are listed and loaded by Spark's ``binaryFile`` source (one row per
file, split across tasks); decoding runs inside the tasks with ``mapInArrow``
(NumPy ``frombuffer``, ``tarfile``, ``gzip``, ``zipfile`` on bytes).  A grid
is emitted as row tiles ``(grid, tr, r0, n, values)`` and turned into cells
with ``posexplode``, so no task ever builds Python objects per cell.
"""

from __future__ import annotations

import gzip
import io
import tarfile
import zipfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the raw daily grids.
RAW_DTYPE = ">i2"          # signed 16-bit, big-endian, row-major (band sequential)
RAW_NODATA = -9999

TILE_SCHEMA = "path string, tr int, r0 int, n_cols int, vals array<int>"


def _tiles_from_bytes(path: str, buf: bytes, n_cols: int, tile_rows: int, n_rows: int | None = None):
    """Row tiles of a flat grid; a file of any other length than rows x columns says is an error."""
    size = np.dtype(RAW_DTYPE).itemsize
    rows = n_rows if n_rows is not None else len(buf) // (size * n_cols)
    if len(buf) != rows * n_cols * size:
        raise ValueError(f"{path}: {len(buf)} bytes are no grid of {n_rows or 'whole'} rows of {n_cols} columns")
    grid = np.frombuffer(buf, dtype=RAW_DTYPE).reshape(rows, n_cols)
    for tr, r0 in enumerate(range(0, rows, tile_rows)):
        block = grid[r0: r0 + tile_rows].astype(np.int32).ravel()
        yield path, tr, r0, n_cols, block


def _member_bytes(path: str, content: bytes, kind: str, member: str | None):
    """Bytes of the grid inside a container of ``kind``: raw, gz, zip or tar (+ gz member)."""
    if kind == "raw":
        return content
    if kind == "gz":
        return gzip.decompress(content)
    if kind == "zip":
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            name = member or next(n for n in z.namelist() if n.endswith(".bil"))
            return z.read(name)
    if kind == "tar":
        with tarfile.open(fileobj=io.BytesIO(content)) as t:
            f = t.extractfile(member)
            data = f.read()
        return gzip.decompress(data) if member.endswith(".gz") else data
    raise ValueError(kind)


def decode_grids(files: DataFrame, n_cols: int, kind: str = "raw", member_of=None,
                 tile_rows: int = 256, n_rows: int | None = None) -> DataFrame:
    """``binaryFile`` rows -> row tiles of int16 values (as int) per file.

    ``member_of(path) -> member name`` picks the archive member for zip / tar.
    """

    def run(batches):
        for b in batches:
            paths = b.column("path").to_pylist()
            contents = b.column("content").to_pylist()
            for p, c in zip(paths, contents):
                raw = _member_bytes(p, c, kind, member_of(p) if member_of else None)
                for path, tr, r0, cols, block in _tiles_from_bytes(p, raw, n_cols, tile_rows, n_rows):
                    vals = pa.ListArray.from_arrays(pa.array([0, len(block)], pa.int32()), pa.array(block, pa.int32()))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([path]), pa.array([tr], pa.int32()), pa.array([r0], pa.int32()), pa.array([cols], pa.int32()), vals],
                        names=["path", "tr", "r0", "n_cols", "vals"])

    return files.select("path", "content").mapInArrow(run, TILE_SCHEMA)


def tiles_to_cells(tiles: DataFrame, nodata: int = RAW_NODATA) -> DataFrame:
    """Row tiles -> cells (path, r, c, v) with the sentinel as NULL."""
    x = tiles.select("path", "r0", "n_cols", F.posexplode("vals").alias("i", "raw"))
    return x.select(
        "path",
        (F.col("r0") + F.floor(F.col("i") / F.col("n_cols"))).cast("int").alias("r"),
        (F.col("i") % F.col("n_cols")).cast("int").alias("c"),
        F.when(F.col("raw") == nodata, F.lit(None).cast("double")).otherwise(F.col("raw").cast("double")).alias("v"),
    )


def read_binary(spark: SparkSession, path: str, glob: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)


INDEX_SCHEMA = "path string, member string, offset long, size long"


def tar_entries(f):
    """(name, offset, size) of every file in a tar archive, from its header blocks alone.

    ``f`` reads at a place (``read_at(n, offset)``).  Long names (GNU and pax)
    come from the small blocks ahead of their member; contents are skipped.
    """
    at, name, size = 0, None, None
    while True:
        block = f.read_at(tarfile.BLOCKSIZE, at)
        if len(block) < tarfile.BLOCKSIZE or not block.strip(b"\0"):
            return
        info = tarfile.TarInfo.frombuf(block, "utf-8", "surrogateescape")
        at += tarfile.BLOCKSIZE
        own = info.size if size is None or info.type in (tarfile.XHDTYPE, tarfile.GNUTYPE_LONGNAME) else size
        if info.type == tarfile.GNUTYPE_LONGNAME:
            name = bytes(f.read_at(own, at)).rstrip(b"\0").decode("utf-8", "surrogateescape")
        elif info.type == tarfile.XHDTYPE:
            for key, value in pax_records(bytes(f.read_at(own, at))):
                name, size = (value, size) if key == "path" else (name, int(value) if key == "size" else size)
        elif info.type != tarfile.XGLTYPE:
            if info.isreg():
                yield name or info.name, at, own
            name = size = None
        at += -(-own // tarfile.BLOCKSIZE) * tarfile.BLOCKSIZE


def pax_records(data: bytes):
    """(key, value) of the ``length key=value`` lines of a pax header."""
    at = 0
    while at < len(data):
        space = data.index(b" ", at)
        end = at + int(data[at:space])
        key, _, value = data[space + 1 : end - 1].partition(b"=")
        yield key.decode(), value.decode("utf-8", "surrogateescape")
        at = end


def archive_index(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """Where every member of the tar archives below a folder lies: path, member, offset, size.  Contents are not read."""
    def run(batches):
        for b in batches:
            for p in b.column("path").to_pylist():
                fs, inner = file_system(p)
                with fs.open_input_file(inner) as f:
                    found = list(tar_entries(f))
                names, offsets, sizes = zip(*found) if found else ((), (), ())
                yield pa.RecordBatch.from_arrays([pa.array([p] * len(found), pa.string()), pa.array(names, pa.string()),
                                                  pa.array(offsets, pa.int64()), pa.array(sizes, pa.int64())],
                                                 names=["path", "member", "offset", "size"])

    return read_binary(spark, path, glob).select("path").mapInArrow(run, INDEX_SCHEMA)


def archive_members(index: DataFrame, unpack: bool = True) -> DataFrame:
    """Contents of the members of an index: path, member, data; ``.gz`` members unpacked.

    Filter the index first: only the bytes of its members are read, and each
    member is a batch of its own, so a task holds one member.
    """
    def run(batches):
        for b in batches:
            for p, name, offset, size in zip(*[b.column(c).to_pylist() for c in ("path", "member", "offset", "size")]):
                fs, inner = file_system(p)
                with fs.open_input_file(inner) as f:
                    data = f.read_at(size, offset)
                data = gzip.decompress(data) if unpack and name.endswith(".gz") else data
                yield pa.RecordBatch.from_arrays([pa.array([p]), pa.array([name]), pa.array([data], pa.binary())],
                                                 names=["path", "member", "data"])

    return index.select("path", "member", "offset", "size").mapInArrow(run, "path string, member string, data binary")


# ------------------------------------------------------------------ writers
def file_system(path: str):
    """File system and inner path of a folder given as URI (file:, hdfs:, s3:) or as a plain local path."""
    from pyarrow import fs

    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    path = path.replace("s3a://", "s3://", 1)
    return fs.FileSystem.from_uri(path if "://" in path else path.replace("file:", "file://", 1))


class GridWriter:
    """One grid, row by row, into the containers ``kinds``; files get their names when they are whole.

    Only the compressed member of the tar archive is held (its size has to be
    known first); all else is streamed.
    """

    def __init__(self, base: str, t: int, header: str | None, kinds):
        import uuid

        self.fs, self.folder = file_system(base)
        self.t, self.header, self.kinds, self.name = t, header, kinds, f"grid_{t}"
        names = {"raw": f"raw/{self.name}.bil", "gz": f"gz/{self.name}.bil.gz", "zip": f"zip/{self.name}_bil.zip",
                 "tar": f"tar/archive_{t}.tar"}
        self.names = {k: names[k] for k in kinds}
        self.own = {k: f"{self.folder}/{k}/.{uuid.uuid4().hex}" for k in kinds}
        self.out = {}
        for k in kinds:
            self.fs.create_dir(f"{self.folder}/{k}", recursive=True)
            self.out[k] = self.fs.open_output_stream(self.own[k])
        self.sinks = []
        if "raw" in kinds:
            self.sinks.append(self.out["raw"])
        if "gz" in kinds:
            self.gz = gzip.GzipFile(fileobj=self.out["gz"], mode="wb", mtime=0)
            self.sinks.append(self.gz)
        if "zip" in kinds:
            self.zip = zipfile.ZipFile(self.out["zip"], "w")
            self.member = self.zip.open(f"{self.name}.bil", "w")
            self.sinks.append(self.member)
        if "tar" in kinds:
            self.packed = io.BytesIO()
            self.tar_gz = gzip.GzipFile(fileobj=self.packed, mode="wb", mtime=0)
            self.sinks.append(self.tar_gz)

    def write(self, raw: bytes) -> None:
        for sink in self.sinks:
            sink.write(raw)

    def close(self) -> int:
        if "gz" in self.kinds:
            self.gz.close()
        if "zip" in self.kinds:
            self.member.close()
            self.zip.close()
        if "tar" in self.kinds:
            self.tar_gz.close()
            members = [(f"{self.name}.dat.gz", self.packed.getvalue())]
            if self.header is not None:
                members.append((f"{self.name}.txt.gz", gzip.compress(self.header.encode("utf-8"), mtime=0)))
            with tarfile.open(fileobj=self.out["tar"], mode="w|") as tar:
                for name, data in members:
                    info = tarfile.TarInfo(name)
                    info.size = len(data)
                    tar.addfile(info, io.BytesIO(data))
        for k in self.kinds:
            self.out[k].close()
            self.fs.move(self.own[k], f"{self.folder}/{self.names[k]}")
        return len(self.kinds)


def write_grid_files(cells: DataFrame, base: str, n_rows: int, n_cols: int, headers: DataFrame | None = None,
                     kinds=("raw", "gz", "zip", "tar")) -> DataFrame:
    """Write every grid (one per ``t``) in the raw container formats below ``base`` (a URI all executors reach).

    Cells are sorted by step, row and column in Spark and streamed through the
    tasks, so a task holds a batch of cells and never a grid.  The header text
    of a step is one more row ahead of its cells.  Files are written under a
    name of their own and moved, so a task that runs again replaces them.
    A value that does not fit the 16 bits of a cell is an error.
    Returns (t, n_files) rows.  Layout: raw/grid_<t>.bil, gz/grid_<t>.bil.gz,
    zip/grid_<t>_bil.zip with member grid_<t>.bil, tar/archive_<t>.tar with
    grid_<t>.dat.gz and, where there is a header, grid_<t>.txt.gz.
    """
    src = cells.select(F.col("t").cast("int").alias("t"), "r", "c", F.col("v").cast("double").alias("v"),
                       F.lit(None).cast("string").alias("header"))
    if headers is not None:
        steps = headers.join(cells.select("t").distinct(), "t", "left_semi")
        src = src.unionByName(steps.select(F.col("t").cast("int").alias("t"), F.lit(-1).alias("r"), F.lit(-1).alias("c"),
                                           F.lit(None).cast("double").alias("v"), F.col("content").alias("header")))
    nodata, dtype, limits = RAW_NODATA, RAW_DTYPE, np.iinfo(RAW_DTYPE)

    def run(batches):
        open_t, writer, header, row, line = None, None, None, 0, np.full(n_cols, nodata, dtype)

        def finish():
            nonlocal row
            while row < n_rows:
                writer.write(line.tobytes())
                line[:] = nodata
                row += 1
            return writer.close()

        def told(t, n):
            return pa.RecordBatch.from_arrays([pa.array([t], pa.int32()), pa.array([n], pa.int32())], names=["t", "n_files"])

        for batch in batches:
            t, r, c = (batch.column(x).to_numpy(zero_copy_only=False) for x in ("t", "r", "c"))
            v = batch.column("v").to_numpy(zero_copy_only=False).astype(np.float64)
            v = np.where(np.isnan(v), nodata, np.rint(v))
            wide = (v < limits.min) | (v > limits.max)
            if wide.any():
                raise ValueError(f"grid {t[wide][0]}: cell value {v[wide][0]:.0f} at row {r[wide][0]}, column {c[wide][0]} does not fit 16 bits")
            v = v.astype(dtype)
            cuts = np.flatnonzero(np.r_[True, (t[1:] != t[:-1]) | (r[1:] != r[:-1])]) if len(t) else []
            for a, b in zip(cuts, [*cuts[1:], len(t)]):
                if t[a] != open_t:
                    if writer is not None:
                        yield told(open_t, finish())
                    open_t, row, writer, header = int(t[a]), 0, None, None
                    line[:] = nodata
                if r[a] < 0:
                    header = batch.column("header")[int(a)].as_py()
                    continue
                if writer is None:
                    writer = GridWriter(base, open_t, header, kinds)
                while row < r[a]:
                    writer.write(line.tobytes())
                    line[:] = nodata
                    row += 1
                line[c[a:b]] = v[a:b]
        if writer is not None:
            yield told(open_t, finish())

    return src.repartition("t").sortWithinPartitions("t", "r", "c").mapInArrow(run, "t int, n_files int")


# Executors need not have this package installed: the task functions above
# (and the module globals they use) are shipped by value with each task.
def _ship_by_value():
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])


_ship_by_value()
