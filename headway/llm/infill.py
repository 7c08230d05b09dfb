"""Fill-in-middle over texts stored as seekable compressed frames.

A text is cut into frames of whole lines, each an independent zstandard frame that carries
the number of lines and characters before it. A cut decompresses only the frame it falls in,
all others go into the output as they are, so the output is a text in frames, too: joined
they are one valid zstandard stream. Digests and the rebuilt text stream frames in order, so
no task holds more than a frame of text beside the row it reads.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from headway.llm.common import blocks, keep, utf8

FRAME_BYTES = 32 << 10
ROWS = 256  # rows whose frames are held as Python values
LEVEL = 3
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARKERS = (PREFIX, SUFFIX, MIDDLE)
PLAIN, PSM, SPM = "plain", "psm", "spm"
ORDERS = {PSM: (PREFIX, SUFFIX, MIDDLE), SPM: (SUFFIX, PREFIX, MIDDLE)}
STORED = (
    "doc_id long, n long, reserved boolean, "
    "frames array<struct<first_unit: long, first_char: long, data: binary>>"
)
TRANSFORMED = (
    "doc_id long, n long, form string, prefix_chars long, middle_chars long, output array<binary>"
)
DIGESTS = (
    "doc_id long, n long, form string, prefix_chars long, middle_chars long, "
    "output_sha256 string, restored_sha256 string"
)


def characters(data: bytes) -> int:
    """Code points of UTF-8 bytes: all bytes but those that go on with one."""
    return int(np.count_nonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80))


def line_ends(data: bytes) -> np.ndarray:
    return np.flatnonzero(np.frombuffer(data, np.uint8) == 10) + 1


def cut_frames(data: bytes, size: int) -> Iterator[tuple[int, int, bytes]]:
    """Lines before, characters before and bytes of every frame.

    Frames end at the first line end from `size` bytes on, so a longer line is in one frame.
    """
    ends = line_ends(data)
    at = unit = chars = 0
    while at < len(data):
        last = int(np.searchsorted(ends, at + size))
        end = int(ends[last]) if last < len(ends) else len(data)
        yield unit, chars, data[at:end]
        unit = last + 1
        chars += characters(data[at:end])
        at = end


def store_frames(documents: DataFrame, frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """The texts as frames, one row per document; `reserved` if a text holds a marker.

    A null text is empty: it has no line and no frame.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=LEVEL)
        schema = pa.schema([
            ("doc_id", pa.int64()), ("n", pa.int64()), ("reserved", pa.bool_()),
            ("frames", pa.list_(pa.struct([
                ("first_unit", pa.int64()), ("first_char", pa.int64()), ("data", pa.binary()),
            ]))),
        ])
        for batch in batches:
            for part in blocks(batch, "text"):
                data, starts = utf8(part.column("text"))
                raw = data.tobytes()
                lines, reserved, frames = [], [], []
                for begin, end in zip(starts[:-1].tolist(), starts[1:].tolist()):
                    text = raw[begin:end]
                    lines.append(text.count(b"\n") + (text[-1:] not in (b"", b"\n")))
                    reserved.append(any(marker in text for marker in MARKERS))
                    frames.append([
                        {"first_unit": unit, "first_char": chars, "data": packer.compress(piece)}
                        for unit, chars, piece in cut_frames(text, frame_bytes)
                    ])
                columns = zip((part.column("doc_id"), lines, reserved, frames), schema.types)
                yield pa.record_batch([pa.array(c, kind) for c, kind in columns], schema)

    return documents.select("doc_id", "text").mapInArrow(run, STORED)


class FramedText:
    """A stored text: parts of it are had by decompressing the frames at their ends."""

    def __init__(self, frames: list[dict], n: int):
        self.frames, self.n = frames, n
        self.units = [f["first_unit"] for f in frames]
        self.packer = zstandard.ZstdCompressor(level=LEVEL)
        self.opener = zstandard.ZstdDecompressor()

    def place(self, unit: int) -> tuple[int, bytes, int]:
        """Where `unit` starts: its frame, the frame's bytes and the offset in them."""
        if unit >= self.n:
            return len(self.frames), b"", 0
        at = int(np.searchsorted(self.units, unit, "right")) - 1
        data, within = b"", 0
        if unit > self.units[at]:
            data = self.opener.decompress(self.frames[at]["data"])
            within = int(line_ends(data)[unit - self.units[at] - 1])
        return at, data, within

    def chars_before(self, unit: int) -> int:
        at, data, within = self.place(unit)
        if at == len(self.frames):
            if not at:
                return 0
            last = self.frames[-1]
            return last["first_char"] + characters(self.opener.decompress(last["data"]))
        return self.frames[at]["first_char"] + characters(data[:within])

    def part(self, first: int, last: int) -> list[bytes]:
        """Frames of the units from `first` up to `last`; whole ones as they are stored."""
        if first >= last:
            return []
        (at, data, begin), (to, tail, end) = self.place(first), self.place(last)
        if begin and at == to:
            return [self.packer.compress(data[begin:end])]
        out = []
        if begin:
            out.append(self.packer.compress(data[begin:]))
            at += 1
        out += [f["data"] for f in self.frames[at:to]]
        if end:
            out.append(self.packer.compress(tail[:end]))
        return out


def draws(doc_id: int | None, seed: int) -> list[int]:
    """Four numbers that depend on the seed and the id alone; a null id reads as no digits."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]


def fill_in_middle(
    stored: DataFrame, seed: int = 7, rate: int = 100, spm_share: int = 50
) -> DataFrame:
    """form, characters of prefix and middle, and `output`, the frames of the new text.

    `rate` percent of the texts are cut at two line ends drawn by their id; of these
    `spm_share` percent give their suffix first. The others, empty texts and those that hold
    a marker stay plain, with null lengths. Each stored row gives one row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=LEVEL)
        mark = {marker: packer.compress(marker) for marker in MARKERS}
        schema = pa.schema([
            ("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()),
            ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.list_(pa.binary())),
        ])

        def changed(doc_id: int | None, n: int, reserved: bool, frames: list[dict]) -> tuple:
            one, two, three, four = draws(doc_id, seed)
            if not n or reserved or three % 100 >= rate:
                return PLAIN, None, None, [f["data"] for f in frames]
            text = FramedText(frames, n)
            first, last = sorted((one % (n + 1), two % (n + 1)))
            parts = {
                PREFIX: text.part(0, first), MIDDLE: text.part(first, last), SUFFIX: text.part(last, n),
            }
            form = SPM if four % 100 < spm_share else PSM
            output = [f for marker in ORDERS[form] for f in (mark[marker], *parts[marker])]
            before = text.chars_before(first)
            return form, before, text.chars_before(last) - before, output

        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                ids, n, reserved, frames = (c.to_pylist() for c in part.columns)
                made = list(zip(*map(changed, ids, n, reserved, frames)))
                columns = zip((ids, n, *made), schema.types)
                yield pa.record_batch([pa.array(c, kind) for c, kind in columns], schema)

    return stored.select("doc_id", "n", "reserved", "frames").mapInArrow(run, TRANSFORMED)



def opened(output: list[bytes]) -> Iterator[bytes]:
    opener = zstandard.ZstdDecompressor()
    for frame in output:
        yield opener.decompress(frame)


def restored(output: list[bytes], form: str) -> Iterator[bytes]:
    """The text from its output and form, frame by frame.

    In a cut text no line holds a marker, so a frame that is one opens a section. Frames are
    gone through again for each section, in the order of the text.
    """
    if form == PLAIN:
        yield from opened(output)
        return
    section, found = None, {marker: [] for marker in MARKERS}
    for frame, data in zip(output, opened(output)):
        if data in found:
            section = data
        else:
            found[section].append(frame)
    for marker in (PREFIX, MIDDLE, SUFFIX):
        yield from opened(found[marker])


def digests(transformed: DataFrame) -> DataFrame:
    """SHA-256 of the output and of the text rebuilt from it, in lower-case hex."""

    def digest(pieces: Iterator[bytes]) -> str:
        sha = hashlib.sha256()
        for piece in pieces:
            sha.update(piece)
        return sha.hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            outputs, back = [], []
            for output, form in zip(batch.column("output"), batch.column("form")):
                frames = output.as_py()
                outputs.append(digest(opened(frames)))
                back.append(digest(restored(frames, form.as_py())))
            kept = batch.columns[:5]
            yield pa.record_batch(
                [*kept, pa.array(outputs, pa.string()), pa.array(back, pa.string())],
                names=[*batch.schema.names[:5], "output_sha256", "restored_sha256"],
            )

    return transformed.mapInArrow(run, DIGESTS)


def texts(transformed: DataFrame) -> DataFrame:
    """doc_id, form and the output as one string."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                joined = [b"".join(opened(o)).decode() for o in part.column("output").to_pylist()]
                yield pa.record_batch(
                    [part.column("doc_id"), part.column("form"), pa.array(joined, pa.string())],
                    names=["doc_id", "form", "output"],
                )

    return transformed.select("doc_id", "form", "output").mapInArrow(
        run, "doc_id long, form string, output string"
    )


def summaries(documents: DataFrame) -> DataFrame:
    """Form, lengths and digests of every document, over a kept table of frames.

    Null and empty texts are plain with no lines. Each row gives one row, repeated or not; a
    null id draws like an id without digits. An empty table gives none; other columns are not
    read. Nothing is shuffled.
    """
    return digests(fill_in_middle(keep(store_frames(documents), "frames")))
