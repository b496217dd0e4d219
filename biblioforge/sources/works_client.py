"""Opt-in client of a works service: fetches records into a snapshot folder that read_works reads.

Keys (DOIs or work ids) are distinct, dealt to a fixed number of tasks and fetched in chunks. A chunk's records are one file of JSON lines,
written under a name of the attempt and then renamed to a name made from its keys, so a repeated task, or a later run, skips what is there: a
key whose answer has been written is never asked for again. The rate is shared: each task waits for its part of it. Answers that ask
to wait (429, 5xx), lost connections and time-outs are tried again, waiting longer each time or as long as the answer says; a key that
still fails is left for the next run and reported. Keys that the service does not know are written as unknown and not asked again.
"""

from __future__ import annotations

import hashlib
import json
import time
import urllib.error
import urllib.parse
import urllib.request
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.identifiers import normalize_doi

#: Answers worth another try.
AGAIN = (408, 425, 429, 500, 502, 503, 504)


@dataclass(frozen=True)
class Service:
    """url holds {key}; rate is requests a second over all tasks, of which there are parallel at most."""

    url: str
    rate: float = 8.0
    parallel: int = 4
    attempts: int = 6
    timeout: float = 30.0
    wait: float = 1.0
    longest_wait: float = 60.0
    chunk: int = 20
    agent: str = "biblioforge"


class Unanswered(Exception):
    """No usable answer after all attempts."""


def ask(service: Service, key: str, sleep: Callable[[float], None] = time.sleep) -> dict | None:
    """The record of a key, or None if the service does not know it."""
    request = urllib.request.Request(service.url.format(key=urllib.parse.quote(key, safe="/:")), headers={"User-Agent": service.agent, "Accept": "application/json"})
    said = ""
    for attempt in range(service.attempts):
        pause = min(service.wait * 2**attempt, service.longest_wait)
        try:
            with urllib.request.urlopen(request, timeout=service.timeout) as answer:
                return json.loads(answer.read().decode())
        except urllib.error.HTTPError as e:
            if e.code in (404, 410):
                return None
            if e.code not in AGAIN:
                raise Unanswered(f"{key}: {e.code}") from e
            said, asked = str(e.code), e.headers.get("Retry-After", "")
            if asked.isdigit():
                pause = min(float(asked), service.longest_wait)
        except (OSError, ValueError) as e:  # no connection, time-out, or half an answer
            said = type(e).__name__
        if attempt + 1 < service.attempts:
            sleep(pause)
    raise Unanswered(f"{key}: {said}")


def _folder(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri.removeprefix("file:"))


def _fetched(folder: str, service: Service):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = _folder(folder)
        files.create_dir(root, recursive=True)
        last = [0.0]

        def one(key: str) -> dict | None:
            rest = last[0] + service.parallel / service.rate - time.monotonic()
            if rest > 0:
                time.sleep(rest)
            last[0] = time.monotonic()
            return ask(service, key)

        keys = [k for batch in batches for k in batch.column("key").to_pylist()]  # of one task: names of some dozen bytes
        for a in range(0, len(keys), service.chunk):
            some = keys[a : a + service.chunk]
            name = f"{root}/works-{hashlib.sha256(chr(10).join(some).encode()).hexdigest()[:32]}.json"
            if files.get_file_info(name).type == fs.FileType.File:
                continue
            lines, failed = [], []
            for key in some:
                try:
                    lines.append(json.dumps((one(key) or {}) | {"asked_key": key}))
                except Unanswered as e:
                    failed.append((key, str(e)))
            if lines:
                part = f"{root}/.{uuid.uuid4().hex}.part"
                with files.open_output_stream(part) as sink:
                    sink.write(("\n".join(lines) + "\n").encode())
                files.move(part, name if not failed else f"{root}/works-{uuid.uuid4().hex}.json")
            if failed:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*failed)], names=["key", "reason"])

    return run


def known_keys(spark: SparkSession, folder: str) -> DataFrame:
    """The keys whose answer the snapshot holds."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/works-*.json")
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path):
        return spark.createDataFrame([], "key string")
    return spark.read.schema("asked_key string").json(folder).select(F.col("asked_key").alias("key")).where("key IS NOT NULL").distinct()


def fetch_works(keys: DataFrame, folder: str, service: Service) -> list[tuple[str, str]]:
    """Adds the records of keys (column key) that the snapshot lacks; returns those that failed, with the last answer. One run at a time per folder."""
    spark = keys.sparkSession
    asked = keys.where("key <> ''").select("key").distinct().join(known_keys(spark, folder), "key", "left_anti")
    dealt = asked.repartition(service.parallel, "key").sortWithinPartitions("key")
    return [tuple(r) for r in dealt.mapInArrow(_fetched(folder, service), "key string, reason string").collect()]


def doi_keys(df: DataFrame, doi: str = "doi") -> DataFrame:
    """The normalised DOIs of a table as keys."""
    return df.select(F.concat(F.lit("doi:"), normalize_doi(doi)).alias("key")).where("key LIKE 'doi:10.%'").distinct()


def cited_keys(works: DataFrame) -> DataFrame:
    """The ids of the works that the works of a snapshot refer to."""
    return works.select(F.explode("referenced_works").alias("url")).select(F.substring_index("url", "/", -1).alias("key")).distinct()
