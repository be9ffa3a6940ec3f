"""Archives of masks (.npz) as a data source: partitions of whole files, only the arrays asked for, filters before reading.

``spark.dataSource.register(MaskArchives)`` once, or ``scan``. A file is one episode of a bounded recording and is read by one
task; nothing in it is unpickled.
"""

from __future__ import annotations

import io
import os
import re
import zipfile
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

#: What a version's name ends with; what stands before it is a project's own.
VERSION = re.compile(r"(?:\w+_)?visible_masks_v([23])")
#: Versions as they are written without a project's name.
V3, V2 = "visible_masks_v3", "visible_masks_v2"
#: Names of channels, roles and arrays in archives: fixed values.
CHANNELS = ("target_0", "receiver_0", "gripper_left", "gripper_right")
ROLES = ("target", "receiver", "gripper", "gripper")
BASE = frozenset({"annotation_status", "format_version", "frame_count", "instance_names", "masks", "qc_status", "roles"})
ABSENT, VISIBLE, HELD = 0, 1, 2
#: How strictly an archive is read.
MODES = ("canonical", "rendering", "channels", "publication")
FIELDS = "path string, episode bigint, version int, frames int, height int, width int, channel int, name string, role string, status string, qc_status string, frame int, code int, mask array<bigint>, reason string"
#: Frames of one channel that make a batch.
BATCH = 256
#: Bytes of files that make a partition, one file at least.
PARTITION = 64 << 20


def _strings(value: np.ndarray) -> list[str] | None:
    return [str(x) for x in value.tolist()] if value.ndim == 1 and value.dtype.kind == "U" else None


def present(masks: np.ndarray) -> np.ndarray:
    """Which frames of which channels have any pixel."""
    return masks.reshape(*masks.shape[:2], -1).any(axis=2)


def encoding_reason(masks: np.ndarray, codes: np.ndarray) -> str | None:
    """Why codes don't fit masks: shape, code, presence, or a held frame that isn't the target's."""
    if codes.dtype != np.uint8 or codes.shape != masks.shape[:2]:
        return "encoding.shape"
    if not np.isin(codes, (ABSENT, VISIBLE, HELD)).all():
        return "encoding.code"
    if not np.array_equal(codes != ABSENT, present(masks)):
        return "encoding.presence"
    return "encoding.held" if (codes[1:] == HELD).any() else None


def archive(arrays: dict[str, np.ndarray], mode: str, frames: int | None = None, required: Sequence[str] = ("target", "receiver")) -> tuple[str | None, dict]:
    """What is wrong with an archive's arrays by the rules of a mode (or None), and its values.

    canonical and publication want exactly the arrays of the version, four channels by name, boolean pixels; publication also
    that required roles are valid and passed and others empty and not applicable. rendering takes further arrays, other
    channels and pixels of any type, and archives without QC; channels the four channels, of any version, with as many frames
    as there should be. Version 2 has no codes: what has pixels is visible.
    """
    strict = mode in ("canonical", "publication")
    needed = BASE if strict else BASE - {"qc_status"}
    if needed - set(arrays):
        return "keys", {}
    label = arrays["format_version"]
    known = VERSION.fullmatch(str(label.item())) if label.ndim == 0 and (not strict or label.dtype.kind == "U") else None
    version = int(known[1]) if known else None
    if version is None and mode != "channels":
        return "version", {}
    if strict and set(arrays) != BASE | ({"frame_encoding"} if version == 3 else set()):
        return "keys", {}
    count = arrays["frame_count"]
    if count.ndim != 0 or count.dtype.kind not in "iu" or (strict and count.item() < 1):
        return "frame_count", {}
    names, roles, status = (_strings(arrays[n]) for n in ("instance_names", "roles", "annotation_status"))
    qc = _strings(arrays["qc_status"]) if "qc_status" in arrays else ["not_run"] * len(roles or ())
    if None in (names, roles, status, qc):
        return "strings", {}
    masks = arrays["masks"] if strict else arrays["masks"].astype(bool)
    if masks.dtype != np.bool_ or masks.ndim != 4 or (mode != "rendering" and masks.shape[0] != len(CHANNELS)):
        return "masks", {}
    if masks.shape[1] != count.item() or (frames is not None and masks.shape[1] != frames):
        return "frames", {}
    if len({masks.shape[0], len(names), len(roles), len(status), len(qc)}) != 1:
        return "lengths", {}
    if mode != "rendering" and tuple(names) != CHANNELS:
        return "names", {}
    if mode != "rendering" and tuple(roles) != ROLES:
        return "roles", {}
    codes = arrays.get("frame_encoding")
    if codes is None:
        if version == 3:
            return "keys", {}
        codes = np.where(present(masks), VISIBLE, ABSENT).astype(np.uint8)
    elif reason := encoding_reason(masks, codes):
        return reason, {}
    if mode == "publication":
        for i, role in enumerate(ROLES[:2]):
            wanted = ("valid", "passed") if role in required else ("not_applicable", "not_applicable")
            if (status[i], qc[i]) != wanted or (role not in required and masks[i].any()):
                return f"role.{role}", {}
    return None, {"version": version, "masks": masks, "codes": codes, "name": names, "role": roles, "status": status, "qc_status": qc}


def words(masks: np.ndarray) -> np.ndarray:
    """Frames of pixels as rows of 64-bit words, whole words to a row of pixels."""
    t, height, width = masks.shape
    padded = np.pad(masks, ((0, 0), (0, 0), (0, -width % 64)))
    return np.packbits(padded.reshape(t, -1), axis=1, bitorder="little").view(np.int64)


_TESTS = {EqualTo: lambda x, v: x == v, In: lambda x, v: x in v, GreaterThan: lambda x, v: x > v, GreaterThanOrEqual: lambda x, v: x >= v, LessThan: lambda x, v: x < v, LessThanOrEqual: lambda x, v: x <= v}


class _Files(InputPartition):
    def __init__(self, files: list[str]) -> None:
        self.files = files


class Decoder:
    """An archive's bytes to batches of rows of a schema, by a mode's rules, for the channels and frames that are asked for."""

    def __init__(self, schema: T.StructType, mode: str = "canonical", frames: int | None = None, required: Sequence[str] = ("target", "receiver")) -> None:
        if mode not in MODES:
            raise ValueError(f"mode is one of {', '.join(MODES)}")
        self.schema, self.mode, self.frames, self.required = schema, mode, frames, required
        self.tests: dict[str, list] = {"path": [], "episode": [], "channel": [], "frame": []}

    def fits(self, name: str, value: object) -> bool:
        return all(value is not None and test(value, v) for test, v in self.tests[name])

    def batches(self, path: str, data: bytes | None) -> Iterator[pa.RecordBatch]:
        try:
            if data is None:
                raise ValueError
            with np.load(io.BytesIO(data), allow_pickle=False) as stored:
                reason, found = archive({k: np.asarray(stored[k]) for k in stored.files}, self.mode, self.frames, self.required)
        except (AttributeError, EOFError, OSError, TypeError, ValueError, zipfile.BadZipFile):  # a lone array has no files
            reason, found = "unreadable", {}
        if reason:
            yield self._batch({"path": [path], "episode": [_episode(path)], "reason": [reason]}, 1)
            return
        masks, packed = found["masks"], "mask" in self.schema.names  # packing is what costs time
        for channel in filter(lambda i: self.fits("channel", i), range(len(masks))):
            at = np.array([t for t in range(masks.shape[1]) if self.fits("frame", t)], np.int32)
            for start in range(0, len(at), BATCH):
                part = at[start : start + BATCH]
                same = {"path": path, "episode": _episode(path), "version": found["version"], "frames": masks.shape[1], "height": masks.shape[2], "width": masks.shape[3], "channel": channel}
                same |= {k: found[k][channel] for k in ("name", "role", "status", "qc_status")}
                columns = {k: [v] * len(part) for k, v in same.items()} | {"frame": part, "code": found["codes"][channel, part].astype(np.int32)}
                yield self._batch(columns | ({"mask": list(words(masks[channel, part]))} if packed else {}), len(part))

    def _batch(self, columns: dict[str, object], n: int) -> pa.RecordBatch:
        kinds = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "array<bigint>": pa.list_(pa.int64())}
        arrays = [pa.array(columns.get(f.name, [None] * n), kinds[f.dataType.simpleString()]) for f in self.schema.fields]
        return pa.RecordBatch.from_arrays(arrays, names=self.schema.names)


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str], schema: T.StructType) -> None:
        self.options = options
        required = tuple(filter(None, options.get("required", "target,receiver").split(",")))
        self.decoder = Decoder(schema, options.get("mode", "canonical"), int(options["frames"]) if "frames" in options else None, required)

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:  # noqa: N802
        """Comparisons of path, episode, channel and frame with values are done here; those of path and episode by leaving files unread.

        An archive that can't be used keeps its one row, whatever channel or frame is asked for: Spark filters these again.
        """
        for f in filters:
            test, name = _TESTS.get(type(f)), ".".join(f.attribute) if hasattr(f, "attribute") else ""
            if test and name in self.decoder.tests:
                self.decoder.tests[name].append((test, f.value))
            if not (test and name in ("path", "episode")):
                yield f

    def partitions(self) -> list[_Files]:
        from pyarrow import fs

        system, root = _filesystem(self.options["path"])
        held, size, out = [], 0, []
        for info in sorted(system.get_file_info(fs.FileSelector(root, recursive=True)), key=lambda i: i.path):
            if info.type != fs.FileType.File or not info.path.endswith(".npz") or not self.decoder.fits("path", info.path) or not self.decoder.fits("episode", _episode(info.path)):
                continue
            if held and size + info.size > int(self.options.get("partitionbytes", PARTITION)):
                out.append(_Files(held))
                held, size = [], 0
            held.append(info.path)
            size += info.size
        return [*out, _Files(held)]

    def read(self, partition: _Files) -> Iterator[pa.RecordBatch]:
        system, _ = _filesystem(self.options["path"])
        for path in partition.files:
            try:
                with system.open_input_stream(path) as stream:
                    data = stream.read()
            except OSError:
                data = None
            yield from self.decoder.batches(path, data)


def _filesystem(path: str):
    """The file system of a path or URI, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", path) if ":/" in path else f"file://{os.path.abspath(path)}")


def _episode(path: str) -> int | None:
    found = re.search(r"episode_(\d+)", path)
    return int(found[1]) if found else None


class MaskArchives(DataSource):
    """Options: path (a folder), mode, frames (how many there should be), required (roles, by comma), partitionbytes."""

    @classmethod
    def name(cls) -> str:
        return "mask_archives"

    def schema(self) -> str:
        return FIELDS

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _Reader(dict(self.options), schema)


def scan(spark: SparkSession, path: str, mode: str = "canonical", columns: Sequence[str] = (), **options: object) -> DataFrame:
    """A row for each frame of each channel of all archives below a folder, or one with the reason for an archive that can't be used.

    With ``columns`` nothing else is made of the arrays. Filters on path and episode leave files unread; for that the session's
    spark.sql.python.filterPushdown.enabled is set.
    """
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(MaskArchives)
    known = T.StructType.fromDDL(FIELDS)
    schema = T.StructType([known[n] for n in columns]) if columns else known
    return spark.read.format("mask_archives").schema(schema).options(mode=mode, **{k: str(v) for k, v in options.items()}).load(path)


def decoded(files: DataFrame, mode: str = "canonical", columns: Sequence[str] = (), frames: int | None = None, required: Sequence[str] = ("target", "receiver")) -> DataFrame:
    """``scan`` of files that Spark has read (path, content), for folders that only Spark's readers can open."""
    known = T.StructType.fromDDL(FIELDS)
    decoder = Decoder(T.StructType([known[n] for n in columns]) if columns else known, mode, frames, required)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, data in zip(*(batch.column(i).to_pylist() for i in (0, 1)), strict=True):
                yield from decoder.batches(path, data)

    return files.select("path", "content").mapInArrow(run, decoder.schema)


def write_archive(target, masks: np.ndarray, codes: np.ndarray | None, status: Sequence[str], qc_status: Sequence[str], version: str = V3) -> None:
    """An archive of four channels to a path or file: version 3 with codes, version 2 without."""
    arrays = {"format_version": np.array(version), "frame_count": np.array(masks.shape[1], np.int64), "masks": masks, "instance_names": np.array(CHANNELS), "roles": np.array(ROLES), "annotation_status": np.array(status), "qc_status": np.array(qc_status)}
    if codes is not None:
        arrays["frame_encoding"] = codes
    reason, _ = archive(arrays, "canonical")
    if reason:
        raise ValueError(reason)
    np.savez_compressed(target, **arrays)


def write_archives(frames: DataFrame, folder: str, height: int, width: int) -> DataFrame:
    """One archive of version 3 for each episode of mask rows (episode, channel, frame, code, mask), as ``folder/episode_N.npz``.

    Frames that have no row are empty. An episode is one group, bounded by its recording; a file is written under another name
    first and shows when it is whole, so that a task that runs again does no harm. Returns episode, frames, and the reason why
    an episode wasn't written.
    """

    def run(frame):
        import uuid

        import pandas as pd

        episode, count = int(frame["episode"].iloc[0]), int(frame["frame"].max()) + 1
        masks, codes = np.zeros((len(CHANNELS), count, height, width), bool), np.zeros((len(CHANNELS), count), np.uint8)
        for channel, at, code, data in frame[["channel", "frame", "code", "mask"]].itertuples(index=False):
            masks[channel, at] = np.unpackbits(np.asarray(data, np.int64).view(np.uint8), bitorder="little").reshape(height, -1)[:, :width].astype(bool)
            codes[channel, at] = code
        used = [bool(c.any()) for c in codes]
        held, reason = io.BytesIO(), None
        try:
            write_archive(held, masks, codes, ["valid" if u else "not_applicable" for u in used], ["passed" if u else "not_applicable" for u in used])
        except ValueError as e:
            reason = str(e)
        else:
            system, root = _filesystem(folder)
            system.create_dir(root, recursive=True)
            staged = f"{root}/.episode_{episode:06d}.{uuid.uuid4().hex}"
            with system.open_output_stream(staged) as out:
                out.write(held.getvalue())
            system.move(staged, f"{root}/episode_{episode:06d}.npz")
        return pd.DataFrame({"episode": [episode], "frames": [count], "reason": [reason]}).astype({"reason": object})

    return frames.select("episode", "channel", "frame", "code", "mask").groupBy("episode").applyInPandas(run, "episode long, frames int, reason string")
