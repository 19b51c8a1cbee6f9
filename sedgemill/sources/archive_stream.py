"""Single archive files of any size: their JSON is walked as a stream, and posts leave in bounded parts.

Spark reads a file as fragments that end at a closing brace, so no value holds a file and any
store Spark can read will do. The fragments of a file pass one task in order; a walker there
holds one post at a time.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, DataFrameReader, functions as F

import sedgemill
from sedgemill.operators.shuffles import lookup_join
from sedgemill.session import written
from sedgemill.sources.many_files import in_few_tasks

cloudpickle.register_pickle_by_value(sedgemill)  # the walker travels with the job

#: Characters read at a time, and posts and characters of a part that is given out.
CHUNK, PART_POSTS, PART_CHARS = 1 << 16, 256, 1 << 20
#: Bytes of a file that is held whole: it is walked where it is read, so its text is not shuffled as fragments.
AT_ONCE = 1 << 20
#: Members of a document that are kept besides its posts.
MEMBERS = ("metadata", "scraped_at", "consolidated_at", "sources", "part")
SPACE = re.compile(r"[ \t\r\n]*")
ROWS = "path string, doc long, run int, first long, body string, head string, bad boolean"


class JsonText:
    """JSON text that arrives in pieces; holds what lies behind the place reached, and no more than a value needs."""

    def __init__(self, pieces: Iterable[str]):
        self.pieces, self.buffer, self.at, self.ended = iter(pieces), "", 0, False
        self.decoder = json.JSONDecoder()

    def _fill(self, want: int) -> None:
        held = [self.buffer[self.at:]]
        size = len(held[0])
        while size < want and not self.ended:
            piece = next(self.pieces, None)
            if piece is None:
                self.ended = True
            else:
                held.append(piece)
                size += len(piece)
        self.buffer, self.at = "".join(held), 0

    def peek(self) -> str:
        """The next character that is no space, or nothing at the end."""
        while True:
            self.at = SPACE.match(self.buffer, self.at).end()
            if self.at < len(self.buffer) or self.ended:
                return self.buffer[self.at:self.at + 1]
            self._fill(CHUNK)

    def take(self, *wanted: str) -> str:
        found = self.peek()
        if found not in wanted or not found:
            raise ValueError(f"expected one of {wanted}, found {found!r}")
        self.at += 1
        return found

    def value(self) -> str:
        """Text of the next value. Where it is cut off, as much again as is held is read before the next try."""
        self.peek()
        while True:
            try:
                end = self.decoder.raw_decode(self.buffer, self.at)[1]
                if end < len(self.buffer) or self.ended:
                    text, self.at = self.buffer[self.at:end], end
                    return text
            except RecursionError as deep:
                raise ValueError("nested too deeply") from deep
            except json.JSONDecodeError as wrong:
                cut_off = wrong.msg.startswith("Unterminated string") or wrong.pos >= len(self.buffer) - 8
                if self.ended or not cut_off:
                    raise
            self._fill(2 * max(len(self.buffer) - self.at, CHUNK // 2))


def walk(pieces: Iterable[str]) -> Iterator[tuple[int, int, str | None, str | None]]:
    """Parts (run, first, posts, None) of a document's posts, then (run, 0, None, head).

    ``posts`` are up to ``PART_POSTS`` posts as written, joined by commas; ``first`` is the
    place of the first of them. ``run`` counts the lists of posts, of which the last one
    holds. ``head`` has the other members, without braces. Text that is no JSON object ends
    in a ValueError.
    """
    yield from _document(JsonText(pieces), alone=True)


def _document(text: JsonText, alone: bool) -> Iterator[tuple[int, int, str | None, str | None]]:
    """``walk`` of the next document; only one that stands alone must have no text behind it."""
    head, run = {}, 0
    text.take("{")
    more = text.peek() != "}"
    if not more:
        text.take("}")
    while more:
        key = json.loads(text.value())
        if not isinstance(key, str):
            raise ValueError("a member without a name")
        text.take(":")
        if key == "posts" and text.peek() == "[":
            run, first, held, size = run + 1, 0, [], 0
            head.pop("posts", None)
            text.take("[")
            open_ = text.peek() != "]"
            if not open_:
                text.take("]")
            while open_:
                held.append(text.value())
                size += len(held[-1])
                open_ = text.take(",", "]") == ","
                if len(held) == PART_POSTS or size > PART_CHARS or not open_:
                    yield run, first, ",".join(held), None
                    first, held, size = first + len(held), [], 0
        elif key == "posts":
            run, head[key] = run + 1, text.value()
        else:
            value = text.value()
            if key in MEMBERS:
                head[key] = value
        more = text.take(",", "}") == ","
    if alone and text.peek():
        raise ValueError("text behind the document")
    yield run, 0, None, ",".join(f"{json.dumps(k)}:{v}" for k, v in head.items())


def _documents(path: str, pieces: Iterable[str], bundled: bool) -> Iterator[tuple]:
    """Rows of the documents of a file, one document or a bundle; what stands behind a fault is part of the unreadable document."""
    text, doc = JsonText(pieces), 0
    try:
        while not bundled or text.peek():
            for part in _document(text, not bundled):
                yield path, doc, *part, False
            doc += 1
            if not bundled:
                return
    except ValueError:
        yield path, doc, 0, 0, None, None, True


def _files(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Iterator[str]]]:
    """(path, pieces) of each file in a sorted run of fragments; the pieces of one are to be used before the next."""
    rows = (r for batch in batches for r in batch.to_pylist())
    row = next(rows, None)
    while row is not None:
        path = row["path"]

        def pieces() -> Iterator[str]:
            nonlocal row
            while row is not None and row["path"] == path:
                yield row["value"] + "}" * row["closed"]
                row = next(rows, None)

        own = pieces()
        yield path, own
        for _ in own:  # what a walker left after an error
            pass


def _held(path: str, text: str) -> Iterator[tuple[str, str, int]]:
    """The rows of ``streamed_documents`` for a file that is held whole."""
    rows = list(_documents(path, [text], False))
    last, head, broken = rows[-1][2], rows[-1][5], rows[-1][6]
    parts = [] if broken else [(first, body) for _, _, run, first, body, _, _ in rows if body is not None and run == last]
    for first, body in parts:
        yield path, f'{{{head}{"," if head else ""}"posts":[{body}]}}', first
    if not parts:
        yield path, "" if broken else f"{{{head}}}", 0


def streamed_documents(reader: DataFrameReader, paths: list[str], bundled: bool = False) -> DataFrame:
    """(path, value, first_pos): documents of one file each, in parts of bounded size; a broken file has one empty value.

    With ``bundled`` a file has any number of documents, one after another. Those before a fault
    hold; the rest of the file has one empty value. The files are walked when this is called: a file
    of one document and up to ``AT_ONCE`` bytes in the task that reads it, others as fragments.
    """
    if bundled:
        return _walked(reader.text(paths, lineSep="}"), True)
    whole = reader.text(paths, wholetext=True)
    small = F.col("_metadata.file_size") <= AT_ONCE

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for path, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for row in _held(path, text):
                    held.append(row)
                    size += len(row[1])
                if len(held) >= PART_POSTS or size > PART_CHARS:
                    yield out(held)
                    held, size = [], 0
        if held:
            yield out(held)

    def out(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    names, kinds = ["path", "value", "first_pos"], [pa.string(), pa.string(), pa.int64()]
    texts = in_few_tasks(whole.where(small), F.col("_metadata.file_path").alias("path"), "value")
    # Read more than once, walked once.
    rows = written(texts.mapInArrow(work, "path string, value string, first_pos long"), "walked-held")
    if whole.where(~small).select("_metadata.file_size").isEmpty():
        return rows
    return rows.unionByName(_walked(reader.text(paths, lineSep="}").where(~small), False))


def _walked(texts: DataFrame, bundled: bool) -> DataFrame:
    """``streamed_documents`` of files of any size, read as lines that end at a closing brace."""
    fragments = texts.select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"), "value")
    # The last fragment of a file was closed by a brace unless the bytes with all braces are one too many.
    sizes = fragments.groupBy("path").agg(
        (F.sum(F.octet_length("value") + 1) == F.max("size") + 1).alias("open"), F.max(F.struct("block", "line")).alias("last"))
    fragments = lookup_join(fragments, sizes, ["path"], "inner").withColumn(
        "closed", ~(F.col("open") & (F.struct("block", "line") == F.col("last"))))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for path, pieces in _files(batches):
            for row in _documents(path, pieces, bundled):
                held.append(row)
                size += len(row[4] or "") + len(row[5] or "")
                if len(held) == PART_POSTS or size > PART_CHARS:
                    yield out(held)
                    held, size = [], 0
        if held:
            yield out(held)

    def out(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    names = ["path", "doc", "run", "first", "body", "head", "bad"]
    kinds = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.string(), pa.bool_()]
    ordered = fragments.select("path", "block", "line", "value", "closed").repartition("path").sortWithinPartitions("path", "block", "line")
    # Read several times below, walked once.
    rows = written(ordered.select("path", "value", "closed").mapInArrow(work, ROWS), "walked")
    # Whether a document is sound, and what its parts share, is known at its end.
    heads = rows.where("body IS NULL").groupBy("path", "doc").agg(
        F.max("run").alias("last"), F.max("head").alias("members"), F.max("bad").alias("broken"))
    parts = lookup_join(rows.where("body IS NOT NULL"), heads, ["path", "doc"], "inner").where(~F.col("broken") & (F.col("run") == F.col("last")))
    member = F.when(F.col("members") != "", F.concat("members", F.lit(","))).otherwise("")
    whole = F.concat(F.lit("{"), member, F.lit('"posts":['), F.col("body"), F.lit("]}"))
    filled = parts.select("path", whole.alias("value"), F.col("first").alias("first_pos"))
    bare = lookup_join(heads, parts.select("path", "doc").distinct(), ["path", "doc"], "left_anti").select(
        "path", F.when(F.col("broken"), "").otherwise(F.concat(F.lit("{"), "members", F.lit("}"))).alias("value"),
        F.lit(0).cast("long").alias("first_pos"))
    return filled.unionByName(bare)
