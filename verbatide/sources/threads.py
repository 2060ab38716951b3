"""Nested discussion threads, and the addresses they come from."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verbatide.functions.text import as_column
from verbatide.schemas import THREAD_COMMENT


# Bytes of comments, with what is kept of their threads, that a task hands on at a time.
BATCH_BYTES = 4 << 20


def _comments_of(document_at: int, strict: bool):
    """A function from Arrow batches of threads to batches of comments in reading order.

    Replies nest without limit, which no fixed column expression can follow. The walk
    keeps its own stack; a document nested too deeply for the JSON library is read by
    the loop below, which keeps one too. Everything it uses lives inside it: workers
    need not have this package.
    """
    batch_bytes = BATCH_BYTES

    def flatten(batches):
        import json
        import re
        from json.decoder import scanstring

        import pyarrow as pa

        blank = re.compile(r"[ \t\n\r]*")
        scalar = re.compile(r"true|false|null|-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][-+]?[0-9]+)?")

        def parse(text):
            """As json.loads, for any depth of arrays and objects."""
            at, stack, value, have = blank.match(text).end(), [], None, False
            while True:
                mark = text[at : at + 1]
                if not have:
                    if mark in ("{", "["):
                        stack.append(({} if mark == "{" else [], None))
                        at = blank.match(text, at + 1).end()
                        if text[at : at + 1] == ("}" if mark == "{" else "]"):
                            value, have = stack.pop()[0], True
                            at = blank.match(text, at + 1).end()
                        elif mark == "{":
                            at = name(text, at, stack)
                        continue
                    if mark == '"':
                        value, at = scanstring(text, at + 1, False)
                    else:
                        found = scalar.match(text, at)
                        if found is None:
                            raise ValueError(f"no JSON at {at}")
                        value, at = json.loads(found[0]), found.end()
                    at, have = blank.match(text, at).end(), True
                    continue
                if not stack:
                    if at != len(text):
                        raise ValueError(f"more after the document at {at}")
                    return value
                holder, key = stack[-1]
                if key is None:
                    holder.append(value)
                else:
                    holder[key] = value
                at = blank.match(text, at + 1).end()
                if mark == ",":
                    have = False
                    if key is not None:
                        at = name(text, at, stack)
                elif mark == ("]" if key is None else "}"):
                    value = stack.pop()[0]
                else:
                    raise ValueError(f"no comma or end before {at}")

        def name(text, at, stack):
            """Read an object's next name; the place of its value."""
            if text[at : at + 1] != '"':
                raise ValueError(f"no name at {at}")
            key, at = scanstring(text, at + 1, False)
            at = blank.match(text, at).end()
            if text[at : at + 1] != ":":
                raise ValueError(f"no colon at {at}")
            stack[-1] = (stack[-1][0], key)
            return blank.match(text, at + 1).end()

        def load(text):
            try:
                return json.loads(text)
            except RecursionError:
                return parse(text)

        def entries(listing):
            data = listing.get("data") if isinstance(listing, dict) else None
            children = data.get("children") if isinstance(data, dict) else None
            return children if isinstance(children, list) else []

        def words(value):
            # A lone surrogate is legal in JSON but not in UTF-8.
            if not isinstance(value, str):
                return ""
            return value.encode("utf-8", "replace").decode("utf-8")

        def number(value):
            is_number = isinstance(value, (int, float)) and not isinstance(value, bool)
            return float(value) if is_number else None

        def comments(document):
            try:
                pending = entries(load(document))[::-1]
            except ValueError:
                if strict:
                    raise
                return
            while pending:
                entry = pending.pop()
                node = entry.get("data") if isinstance(entry, dict) else None
                if not isinstance(node, (dict, list)) or entry.get("kind") != "t1":
                    continue
                fields = node if isinstance(node, dict) else {}
                texts = [words(fields.get(f)) for f in ("id", "author", "body")]
                yield (*texts, number(fields.get("score")), number(fields.get("depth")))
                pending.extend(entries(fields.get("replies"))[::-1])

        def batch_of(batch, rows, found):
            kept = [n for i, n in enumerate(batch.schema.names) if i != document_at]
            at = pa.array(rows, pa.int64())
            position, *parts = zip(*found) if found else ((),) * 6
            kinds = (pa.string(),) * 3 + (pa.float64(),) * 2
            columns = [batch.column(n).take(at) for n in kept]
            columns.append(pa.array(position, pa.int32()))
            columns += [pa.array(p, k) for p, k in zip(parts, kinds)]
            made = ["position", "id", "author", "body", "score", "depth"]
            return pa.RecordBatch.from_arrays(columns, [*kept, *made])

        for batch in batches:
            rows, found, size = [], [], 0
            kept = [c for i, c in enumerate(batch.columns) if i != document_at]
            for row in range(batch.num_rows):
                document = batch.column(document_at)[row].as_py()
                if document is None:
                    continue
                # Every comment of the thread repeats these.
                repeated = 64 + sum(c.slice(row, 1).nbytes for c in kept)
                for position, comment in enumerate(comments(document)):
                    rows.append(row)
                    found.append((position, *comment))
                    size += repeated + sum(map(len, comment[:3]))
                    if size >= batch_bytes:
                        yield batch_of(batch, rows, found)
                        rows, found, size = [], [], 0
            yield batch_of(batch, rows, found)

    return flatten


def flatten_threads(
    threads: DataFrame, document: str = "document", strict: bool = False
) -> DataFrame:
    """One row per comment of each thread, with its place ``position`` in the thread.

    Only entries of kind ``t1`` count, their replies right after them. A
    document that is no JSON yields nothing, or fails the query if ``strict``.
    """
    kept = [field for field in threads.schema.fields if field.name != document]
    made = [T.StructField("position", T.IntegerType()), *THREAD_COMMENT.fields]
    return threads.mapInArrow(
        _comments_of(threads.columns.index(document), strict), T.StructType([*kept, *made])
    )


def permalink_segment(url, index: int) -> Column:
    """The path's index-th non-empty segment, counted from 0; null if there is none."""
    path = F.try_parse_url(as_column(url), F.lit("PATH"))
    segments = F.filter(F.split(path, "/"), lambda part: part != "")
    return F.try_element_at(segments, F.lit(index + 1))


def parse_permalinks(urls: DataFrame, url: str = "url") -> DataFrame:
    """Community and post code of each address; ``#`` lines and blanks are skipped."""
    address = F.trim(url)
    return urls.filter((address != "") & ~address.startswith("#")).withColumns(
        {
            "community": permalink_segment(address, 1),
            "post_code": permalink_segment(address, 3),
        }
    )
