"""Binary parts: blocked gzip and BAM files written by tasks, and joining of parts to one file.

Tasks write through pyarrow's file systems (local, HDFS, object stores), each to a name of its attempt that is then moved
into place, so a retried task leaves no half file.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

#: Fixed value: the empty block that ends a blocked gzip file.
BGZF_END = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")
BGZF_BLOCK = 65_280


def bgzf(data: Iterable[bytes], end: bool = True) -> Iterator[bytes]:
    """Blocked gzip of a stream."""
    held = bytearray()

    def block(raw: bytes) -> bytes:
        z = zlib.compressobj(6, zlib.DEFLATED, -15)
        body = z.compress(raw) + z.flush()
        return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff\x06\0BC\x02\0" + struct.pack("<H", len(body) + 25) + body + struct.pack("<II", zlib.crc32(raw), len(raw))

    for piece in data:
        held += piece
        while len(held) >= BGZF_BLOCK:
            yield block(bytes(held[:BGZF_BLOCK]))
            del held[:BGZF_BLOCK]
    if held:
        yield block(bytes(held))
    if end:
        yield BGZF_END


def open_fs(path: str):  # noqa: ANN201
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path else path.removeprefix("file:"))


def write_parts(lines: DataFrame, path: str, suffix: str, mode: str = "overwrite", end: bool = True, encode: Callable[[Iterator[pa.RecordBatch]], Iterable[bytes]] | None = None) -> None:
    """Blocked gzip files, one a partition, of what `encode` makes of its batches; without it of the `value` column (text lines get a line end;
    binary is taken as it is). Without `end` no file has the closing block: `join_blocked` adds it."""
    fs, root = open_fs(path)
    from pyarrow.fs import FileSelector, FileType

    exists = fs.get_file_info(root).type != FileType.NotFound
    if exists and mode in ("errorifexists", "error"):
        raise FileExistsError(path)
    if exists and mode == "ignore":
        return
    if exists and mode == "overwrite":
        fs.delete_dir(root)
    fs.create_dir(root, recursive=True)
    if encode is None:
        binary = lines.schema["value"].dataType.simpleString() == "binary"
        encode = lambda batches: (v if binary else v.encode() + b"\n" for b in batches for v in b.column(0).to_pylist())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        own, folder = open_fs(path)
        name = f"part-{task.partitionId():05d}{suffix}"
        draft = f"{folder}/_{name}-{task.taskAttemptId()}"

        with own.open_output_stream(draft) as out:
            for block in bgzf(encode(batches), end=end):
                out.write(block)
        own.move(draft, f"{folder}/{name}")
        yield pa.RecordBatch.from_arrays([pa.array([name], pa.string())], names=["name"])

    done = {r.name for r in lines.mapInArrow(run, "name string").collect()}  # one row per partition
    for f in fs.get_file_info(FileSelector(root)):
        if f.base_name not in done:
            fs.delete_file(f.path)
    with fs.open_output_stream(f"{root}/_SUCCESS"):
        pass


def join_files(folder: str, path: str, before: bytes, after: bytes = b"") -> None:
    """One file of the parts in a folder, in order, between two pieces; the folder goes."""
    fs, root = open_fs(folder)
    _, target = open_fs(path)
    from pyarrow.fs import FileSelector

    with fs.open_output_stream(target, compression=None) as out:
        out.write(before)
        for name in sorted(f.path for f in fs.get_file_info(FileSelector(root)) if f.base_name.startswith("part-")):
            with fs.open_input_stream(name, compression=None) as part:
                while piece := part.read(1 << 22):
                    out.write(piece)
        out.write(after)
    fs.delete_dir(root)


def join_blocked(folder: str, path: str, head: bytes) -> None:
    """One blocked gzip file of parts written without closing blocks."""
    join_files(folder, path, b"".join(bgzf([head], end=False)), BGZF_END)


def join_parts(text: DataFrame, path: str, head: str, codec: str = "") -> None:
    """Write `text` (value, in partition order) in parallel, then join header and parts to the single file `path`."""
    import gzip

    tmp = f"{path}.parts"
    if codec == "bgzf":
        write_parts(text, tmp, ".bgz", end=False)
        join_blocked(tmp, path, head.encode())
        return
    text.write.mode("overwrite").option("compression", "gzip" if codec == "gzip" else "none").text(tmp)
    join_files(tmp, path, gzip.compress(head.encode()) if codec == "gzip" else head.encode())
