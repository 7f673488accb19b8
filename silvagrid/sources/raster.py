"""Uncompressed strip images (baseline TIFF, one band of 8 or 16 bits) as a data source and a sink.

An archive is a folder of files ``scene-<id>_r<row>_c<column>.tif``, each a piece of a scene that begins at that row and
column; a large scan is several files. Reading is planned from names and sizes alone: files of scenes that a filter rules
out are never opened, a large file is several partitions, each a group of its strips.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silvagrid.functions.grid import floor_div

FORMAT = "strip_images"
SCHEMA = "scene_id int, r int, c int, dn int"
#: Level that stands for nodata in files that are written; the file says so in its own nodata tag.
NODATA = 65535
#: A private tag lists the stretches of cells that a scene lacks, by first cell and length in row-major order; other
#: readers see nodata there.


def _tiff():
    """Functions on baseline TIFF, nested so that they travel to the workers: (encode, read_header, strips)."""
    import struct

    # Tags and field types of the format.
    width_, length_, bits_, packed_, light_, offsets_, samples_, rows_, counts_, nodata_ = (256, 257, 258, 259, 262, 273, 277, 278, 279, 42113)
    absent_ = 65101
    short, long_, ascii_ = 3, 4, 2
    sizes = {1: 1, 2: 1, 3: 2, 4: 4}

    def encode(image, rows_per_strip, nodata, absent):
        """A two-dimensional uint16 array as a file of strips. ``absent``: first cells and lengths in turn."""
        h, w = image.shape
        n = -(-h // rows_per_strip)
        text = f"{nodata}\0".encode()
        entries = 10 + (len(absent) > 0)
        extra = 8 + 2 + 12 * entries + 4
        at = {offsets_: extra, counts_: extra + 4 * n, nodata_: extra + 8 * n}
        gaps = extra + 8 * n + len(text) + (len(text) % 2)
        data = gaps + 4 * len(absent)
        starts = [data + 2 * w * rows_per_strip * i for i in range(n)]
        lengths = [2 * w * min(rows_per_strip, h - rows_per_strip * i) for i in range(n)]

        def entry(tag, kind, count, value):
            return struct.pack("<HHII", tag, kind, count, value)

        def listed(tag, values):
            return entry(tag, long_, n, values[0] if n == 1 else at[tag])

        head = struct.pack("<2sHIH", b"II", 42, 8, entries)
        head += entry(width_, long_, 1, w) + entry(length_, long_, 1, h) + entry(bits_, short, 1, 16) + entry(packed_, short, 1, 1)
        head += entry(light_, short, 1, 1) + listed(offsets_, starts) + entry(samples_, short, 1, 1) + entry(rows_, long_, 1, rows_per_strip)
        head += listed(counts_, lengths) + entry(nodata_, ascii_, len(text), at[nodata_])
        head += (entry(absent_, long_, len(absent), gaps) if len(absent) else b"") + struct.pack("<I", 0)
        head += struct.pack(f"<{n}I", *starts) + struct.pack(f"<{n}I", *lengths) + text + b"\0" * (len(text) % 2)
        head += struct.pack(f"<{len(absent)}I", *absent)
        return head + image.astype("<u2").tobytes()

    def read_header(file):
        """The tags of a file's first image; a file of another kind raises."""
        order = {b"II": "<", b"MM": ">"}.get(file.read(2))
        if order is None or struct.unpack(order + "H", file.read(2))[0] != 42:
            raise ValueError("not a TIFF file")
        file.seek(struct.unpack(order + "I", file.read(4))[0])
        tags = {}
        rows = file.read(12 * struct.unpack(order + "H", file.read(2))[0])
        for i in range(0, len(rows), 12):
            tag, kind, count = struct.unpack(order + "HHI", rows[i : i + 8])
            if kind not in sizes:
                continue
            raw = rows[i + 8 : i + 12]
            if sizes[kind] * count > 4:
                file.seek(struct.unpack(order + "I", raw)[0])
                raw = file.read(sizes[kind] * count)
            tags[tag] = raw[:count] if kind == ascii_ else list(struct.unpack(f"{order}{count}{'_BsHI'[kind]}", raw[: sizes[kind] * count]))
        if tags.get(packed_, [1]) != [1] or tags.get(samples_, [1]) != [1] or tags.get(bits_) not in ([8], [16]):
            raise ValueError("only uncompressed images of one band of 8 or 16 bits are read")
        level = tags.get(nodata_, b"").rstrip(b"\0 ")
        return {
            "w": tags[width_][0], "h": tags[length_][0], "kind": f"{order}u{tags[bits_][0] // 8}", "rows": tags.get(rows_, tags[length_])[0],
            "offsets": tags[offsets_], "counts": tags[counts_], "nodata": float(level) if level else None,
            "absent": tags.get(absent_, []),
        }

    def strips(file, head, first, last):
        """(first row, image) of the strips from ``first`` up to ``last``, one at a time."""
        import numpy as np

        for i in range(first, last):
            file.seek(head["offsets"][i])
            yield i * head["rows"], np.frombuffer(file.read(head["counts"][i]), head["kind"]).reshape(-1, head["w"])

    return encode, read_header, strips


def _source():
    """The data source class, nested like the functions above."""
    from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, In, InputPartition

    _, read_header, strips = _tiff()
    schema = SCHEMA

    def located(path):
        """A file system that reads the path, and the path as it names it: mounted folders and the stores that Arrow knows."""
        from pyarrow import fs

        return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)

    class Piece(InputPartition):
        def __init__(self, path, scene, row, column, part, parts):
            self.path, self.scene, self.row, self.column, self.part, self.parts = path, scene, row, column, part, parts

    class Reader(DataSourceReader):
        def __init__(self, options):
            self.path, self.piece = options["path"], int(options.get("partitionbytes", 64 << 20))
            self.scenes = None

        def pushFilters(self, filters):
            for f in filters:
                wanted = {EqualTo: lambda f: {f.value}, In: lambda f: set(f.value)}.get(type(f))
                if wanted is None or f.attribute != ("scene_id",):
                    yield f
                else:
                    self.scenes = wanted(f) if self.scenes is None else self.scenes & wanted(f)

        def partitions(self):
            import re

            from pyarrow import fs

            store, top = located(self.path)
            out = []
            for found in store.get_file_info(fs.FileSelector(top, recursive=True)):
                name = re.fullmatch(r"scene-(-?\d+)_r(-?\d+)_c(-?\d+)\.tif", found.base_name)
                if name and (self.scenes is None or int(name[1]) in self.scenes):
                    parts = max(1, -(-found.size // self.piece))
                    out += [Piece(found.path, *map(int, name.groups()), k, parts) for k in range(parts)]
            return out or [Piece(None, 0, 0, 0, 0, 1)]

        def read(self, piece):
            import numpy as np
            import pyarrow as pa

            if piece.path is None:
                return
            store, _ = located(self.path)
            with store.open_input_file(piece.path) as file:
                head = read_header(file)
                n = len(head["offsets"])
                begin, length = (np.array(head["absent"][k::2], np.int64) for k in (0, 1))
                for row, image in strips(file, head, n * piece.part // piece.parts, n * (piece.part + 1) // piece.parts):
                    h, w = image.shape
                    level = image.ravel().astype(np.int32)
                    r = np.repeat(np.arange(row, row + h, dtype=np.int32) + np.int32(piece.row), w)
                    c = np.tile(np.arange(w, dtype=np.int32) + np.int32(piece.column), h)
                    gone = level == head["nodata"] if head["nodata"] is not None else np.zeros(len(level), bool)
                    if len(begin):
                        place = np.arange(row * w, (row + h) * w, dtype=np.int64)
                        k = np.searchsorted(begin, place, "right") - 1
                        there = (k < 0) | (place >= begin[k] + length[k])
                        r, c, level, gone = r[there], c[there], level[there], gone[there]
                    columns = [pa.array(np.full(len(r), piece.scene, np.int32)), pa.array(r), pa.array(c), pa.array(level, mask=gone)]
                    yield pa.RecordBatch.from_arrays(columns, ["scene_id", "r", "c", "dn"])

    class StripImages(DataSource):
        @classmethod
        def name(cls):
            return "strip_images"

        def schema(self):
            return schema

        def reader(self, schema):
            return Reader(self.options)

    return StripImages


def read_strips(spark: SparkSession, path: str, partition_bytes: int = 64 << 20) -> DataFrame:
    """Pixels ``scene_id, r, c, dn`` of a folder of strip images; nodata is NULL.

    ``filter`` on ``scene_id`` (equal to, or one of) is pushed into the source: other scenes' files are not opened. A partition is
    a group of strips of about ``partition_bytes``; a strip is read whole. Other files in the folder are passed over, an image of
    another kind raises. An empty folder gives no rows.
    """
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(_source())
    return spark.read.format(FORMAT).option("partitionBytes", str(partition_bytes)).load(path)


def write_strips(px: DataFrame, path: str, rows: int = 1024, columns: int = 16384, strip: int = 64) -> DataFrame:
    """Write pixels as strip images and return ``scene_id, r, c, n_px`` of the files.

    A file is a piece of at most ``rows`` x ``columns`` cells, written by one task under another name first, so that a
    repeated task leaves one whole file. Levels lie between 0 and 65,534, others raise. NULL becomes nodata, and so do cells that
    are absent from the smallest rectangle around a piece's cells; the file also lists these, and ``read_strips`` leaves them out.
    ``path`` is a folder that all workers have mounted.
    """
    at = [(floor_div(F.col(x), n) * n).cast("int").alias(f"_{x}") for x, n in (("r", rows), ("c", columns))]
    encode, _, _ = _tiff()
    nodata = NODATA
    folder = path.removeprefix("file://").removeprefix("file:")

    def write(key, table):
        import os
        import uuid

        import numpy as np
        import pyarrow as pa

        scene = key[0].as_py()
        r, c = (table.column(x).to_numpy() for x in ("r", "c"))
        row, column = int(r.min()), int(c.min())
        level = table.column("dn").to_numpy()
        gone = np.isnan(level.astype(float))
        level = np.where(gone, nodata, level).astype(np.int64)
        if ((level < 0) | ((level >= nodata) & ~gone)).any():
            raise ValueError("levels must lie between 0 and 65534")
        image = np.full((r.max() - row + 1, c.max() - column + 1), nodata, np.uint16)
        image[r - row, c - column] = level
        lacking = np.ones(image.shape, np.int8)
        lacking[r - row, c - column] = 0
        edges = np.flatnonzero(np.diff(lacking.ravel(), prepend=0, append=0))
        absent = np.stack([edges[::2], edges[1::2] - edges[::2]], axis=1).ravel().tolist()
        os.makedirs(folder, exist_ok=True)
        part = os.path.join(folder, f".{uuid.uuid4().hex}")
        with open(part, "wb") as f:
            f.write(encode(image, strip, nodata, absent))
        os.replace(part, os.path.join(folder, f"scene-{scene}_r{row}_c{column}.tif"))
        return pa.table({n: pa.array([v], k) for n, v, k in (("scene_id", scene, pa.int32()), ("r", row, pa.int32()), ("c", column, pa.int32()), ("n_px", len(r), pa.int64()))})

    cells = px.select(*[F.col(x).cast("int").alias(x) for x in ("scene_id", "r", "c", "dn")], *at)
    return cells.groupBy("scene_id", "_r", "_c").applyInArrow(write, "scene_id int, r int, c int, n_px long")
