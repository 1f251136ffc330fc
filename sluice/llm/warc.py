"""WARC archives: writing and reading records, and capture histories by an external index merge.

Records go through Spark's text sink, one record (as raw bytes) a line that
ends with the blank lines a record ends with, so archives land on any store
Spark writes to.  They are read back as whole binary files and parsed by their
Content-Length fields, each file giving a run of index entries that its task
sorts by URL key and time.

Index merge: splitters taken from the runs cut the key space (URL key, time,
record id) into ranges; every run hands each range its sorted slice, and one
task per range merges its slices with a loser tree.  Ranges in order are the
capture histories in order.  Splitters include the time and the record, so the
captures of one URL, however many, are spread over ranges too.
"""

from __future__ import annotations

import hashlib
import re
from urllib.parse import quote, urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.common import Scratch, blocks_for

FILE_BYTES = 16 << 20
MIN_REVISIT = 1000
BROADCAST_REVISITS = 200_000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EPOCH = 1_577_836_800  # 2020-01-01T00:00:00Z


def surt(url: str | None) -> str:
    """Sort-friendly key of a URL: host labels reversed, scheme, user, port and fragment left out, lower case host."""
    if not url:
        return ""
    try:
        parts = urlsplit(url)
        host = (parts.hostname or "").lower()
    except ValueError:
        return url
    host = ",".join(reversed(re.sub(r"^www\d*\.", "", host).split(".")))
    return f"{host}){parts.path or '/'}" + (f"?{parts.query}" if parts.query else "")


class LoserTree:
    """Tournament tree over ``k`` sorted iterators; each step replays one leaf's path to the root."""

    def __init__(self, runs):
        self.runs = [iter(r) for r in runs]
        self.k = max(1, len(self.runs))
        self.head = [next(r, None) for r in self.runs] or [None]
        self.lost = [-1] * self.k
        for leaf in range(self.k):
            self._replay(leaf)

    def _beats(self, a: int, b: int) -> bool:
        """Whether leaf ``a`` goes before leaf ``b``; -1 (no player yet) beats all, an empty run beats none."""
        if a == -1 or b == -1:
            return a == -1
        x, y = self.head[a], self.head[b]
        if x is None or y is None:
            return x is not None or (y is None and a < b)
        return (x, a) < (y, b)

    def _replay(self, leaf: int) -> None:
        at, winner = (leaf + self.k) // 2, leaf
        while at > 0:
            if self._beats(self.lost[at], winner):
                self.lost[at], winner = winner, self.lost[at]
            at //= 2
        self.lost[0] = winner

    def __iter__(self):
        while (head := self.head[leaf := self.lost[0]]) is not None:
            yield head
            self.head[leaf] = next(self.runs[leaf], None)
            self._replay(leaf)


def _field(value: str) -> str:
    """A header value without control characters or spaces, percent-encoded."""
    return quote(value, safe="%/:=&?~#+!$,;'@()*[]")


def _record_id(col):
    """The record identifier of a page id; null for null."""
    h = F.sha1(col.cast("string"))
    return F.when(col.isNotNull(), F.concat(F.lit("urn:uuid:"), F.concat_ws(
        "-", h.substr(1, 8), h.substr(9, 4), F.concat(F.lit("5"), h.substr(14, 3)), F.concat(F.lit("8"), h.substr(18, 3)), h.substr(21, 12))))


def decide(pages: DataFrame, tmp: Scratch, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """Add ``digest``, ``refers_to`` and ``refers_url`` to ``page_id, url, payload, captured``.

    Of records with equal payloads of at least ``min_revisit`` bytes the one
    with the largest id is the response, the others refer to it.  Only ids and
    digests are grouped; payloads stay where they are read while the revisits
    are few enough to be sent to all executors, else they move once.
    """
    long = F.octet_length("payload") >= min_revisit
    keys = tmp.keep(pages.where(long).select("page_id", "url", F.sha1("payload").alias("digest"), F.sha2("payload", 256).alias("same")), "digests")
    top = (keys.groupBy("same").agg(F.max(F.struct("page_id", "url")).alias("top"), F.count(F.lit(1)).alias("n"))
           .where("n > 1").select("same", "top"))
    revisits = (keys.join(top, "same").where(F.col("page_id") < F.col("top.page_id"))
                .select("page_id", "digest", F.col("top.page_id").alias("refers_to"), F.col("top.url").alias("refers_url")).distinct())
    revisits = tmp.keep(revisits, "revisits")
    few = revisits.count() <= BROADCAST_REVISITS
    return pages.withColumn("digest", F.sha1("payload")).join(F.broadcast(revisits) if few else revisits, ["page_id", "digest"], "left")


def write_archives(pages: DataFrame, path: str, per_file: int) -> None:
    """Write a record per row of ``pages`` (page_id, url, payload, captured, digest, refers_to, refers_url), at most ``per_file`` to an archive."""
    def render(batches):
        import pandas as pd

        for pdf in batches:
            out = []
            for r in pdf.itertuples(index=False):
                revisit = isinstance(r.refers, str)
                body = b"" if revisit else bytes(r.payload)
                http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(r.payload)}\r\n\r\n".encode()
                head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <{r.record}>", f"WARC-Date: {r.date}"]
                if isinstance(r.url, str):
                    head.append(f"WARC-Target-URI: {_field(r.url)}")
                if isinstance(r.page_id, str):
                    head.append(f"WARC-X-Page-ID: {r.page_id}")
                head.append(f"WARC-Payload-Digest: sha1:{r.digest}")
                if revisit:
                    head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{r.refers}>", f"WARC-X-Refers-To-Page-ID: {r.refers_to}"]
                    if isinstance(r.refers_url, str):
                        head.append(f"WARC-Refers-To-Target-URI: {_field(r.refers_url)}")
                head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(http) + len(body)}", "", ""]
                out.append("\r\n".join(head).encode() + http + body)
            yield pd.DataFrame({"record": out})

    rows = pages.select(
        "page_id", "url", "payload", "digest", "refers_to", "refers_url",
        _record_id(F.coalesce(F.col("page_id").cast("string"), F.col("digest"))).alias("record"), _record_id(F.col("refers_to")).alias("refers"),
        F.date_format(F.timestamp_seconds("captured"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("date"))
    rows = rows.withColumns({c: F.col(c).cast("string") for c in ("page_id", "refers_to")})
    lines = rows.mapInPandas(render, "record binary").select(F.col("record").cast("string").alias("value"))
    lines.write.option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", per_file).text(path)


def parse(data: bytes):
    """The records of an archive: ``(offset, length, header fields in lower case, block)`` each."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        fields = {}
        for line in data[at:end].split(b"\r\n")[1:]:
            name, _, value = line.partition(b":")
            fields[name.decode().lower()] = value.strip().decode()
        size = int(fields["content-length"])
        block = memoryview(data)[end + 4:end + 4 + size]
        if data[end + 4 + size:end + 8 + size] != b"\r\n\r\n":
            raise ValueError(f"record at {at}: no end after its {size} bytes")
        yield at, end + 8 + size - at, fields, block
        at = end + 8 + size


ENTRY = ("urlkey string, captured string, record string, page_id long, url string, record_type string, payload_bytes long, "
         "payload_digest string, refers_to long, file string, offset long, length long, whole boolean, nth long")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """Index entries of all records under ``path``, each file's sorted by (urlkey, captured, record).

    ``whole`` tells whether a response's payload has the digest its header states.
    """
    def entries(batches):
        import pandas as pd

        names = [c.split()[0] for c in ENTRY.split(", ")]
        for pdf in batches:
            for name, data in zip(pdf["path"], pdf["content"]):
                run = []
                for offset, length, f, block in parse(data):
                    block = bytes(block)
                    http, _, body = block.partition(b"\r\n\r\n")
                    size = int(re.search(rb"(?i)\r\ncontent-length: *(\d+)", http)[1])
                    url, page, refers = f.get("warc-target-uri"), f.get("warc-x-page-id"), f.get("warc-x-refers-to-page-id")
                    digest = f["warc-payload-digest"].removeprefix("sha1:")
                    whole = f["warc-type"] == "revisit" or (len(body) == size and hashlib.sha1(body).hexdigest() == digest)
                    run.append((surt(url), f["warc-date"], f["warc-record-id"], page and int(page), url, f["warc-type"], size, digest,
                                refers and int(refers), name, offset, length, whole))
                run.sort(key=lambda r: (r[0], r[1], r[2], r[10]))
                out = pd.DataFrame([(*r, i) for i, r in enumerate(run)], columns=names)
                for c in ("page_id", "refers_to"):
                    out[c] = out[c].astype("Int64")
                yield out

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    return files.mapInPandas(entries, ENTRY)


def sound(index: DataFrame) -> DataFrame:
    """``index``, failing at a record whose payload has not the digest or the length that its header states."""
    damaged = F.concat(F.lit("damaged record in "), "file", F.lit(" at "), F.col("offset").cast("string"))
    return index.withColumn("whole", F.when(F.col("whole"), F.lit(True)).otherwise(F.raise_error(damaged).cast("boolean")))


ORDER = ("urlkey", "captured", "record", "offset")
MAX_RANGES, MAX_KEYS = 200_000, 1_000_000


def merge_index(index: DataFrame, per_range: int = 50_000) -> DataFrame:
    """Merge the runs of ``index`` (one per ``file``, with ``nth`` telling the order) into capture histories.

    Returns its rows with ``range`` and ``place``: rows ordered by these are
    ordered by URL key, time and record over all archives.  Splitters come from
    a sample of at most a million keys and number at most 200,000.
    """
    import bisect

    rows = index.count()
    n = min(MAX_RANGES, blocks_for(rows, per_range))
    splits = []
    if n > 1:
        some = index.select(*ORDER).sample(min(1.0, min(100 * n, MAX_KEYS) / rows), seed=1).collect()
        some = sorted(tuple(r) for r in some)
        splits = [some[len(some) * k // n] for k in range(1, n)] if some else []

    def slices(batches):
        for pdf in batches:
            pdf["range"] = [bisect.bisect_right(splits, k) for k in zip(*(pdf[c] for c in ORDER))]
            yield pdf

    def merge(pdf):
        runs = [run.index[run["nth"].argsort()] for _, run in pdf.groupby("file", sort=False)]
        keys = list(zip(*(pdf[c] for c in ORDER)))
        order = [i for _, i in LoserTree(((keys[i], i) for i in run) for run in runs)]
        out = pdf.iloc[order].reset_index(drop=True)
        out["place"] = range(len(out))
        return out

    schema = f"{ENTRY}, range int"
    return index.mapInPandas(slices, schema).groupBy("range").applyInPandas(merge, f"{schema}, place long").drop("nth")


def archive(pages: DataFrame, path: str | None = None, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
            captured: str | None = None, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """Write ``pages`` to archives under ``path`` (unset: in the shared folder), read them back and return the merged index.

    ``captured`` names a column of capture seconds since 1970; without one, pages
    are captured a second apart in the order of their ids.  A null payload is
    empty; a null URL is left out of its record and sorts first; a null id gets
    no id field.  Rows that repeat an id with another payload are records of
    their own, of which a revisit refers to the id alone; rows that repeat
    another altogether are written again.  A record that does not read back
    whole stops the job.  Other columns are left out.
    """
    payload = F.coalesce(F.col(payload_col), F.lit("")).cast("binary")
    at = F.col(captured).cast("long") if captured else F.lit(EPOCH) + F.coalesce(F.col(id_col), F.lit(0)).cast("long") % 1_000_000_000
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), payload.alias("payload"), at.alias("captured"))
    total = rows.agg(F.sum(F.octet_length("payload") + 800).alias("bytes"), F.count(F.lit(1)).alias("n")).first()
    spark = pages.sparkSession
    tmp = Scratch(spark, "warc")
    path = path or tmp.path("archives")
    write_archives(decide(rows, tmp, min_revisit), path, max(1, FILE_BYTES * total["n"] // max(1, total["bytes"] or 1)))
    return merge_index(tmp.keep(sound(read_index(spark, path)), "index"))
