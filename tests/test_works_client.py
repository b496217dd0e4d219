import json
import threading
import time
from collections import Counter
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest

from biblioforge.sources import tables, works_client
from biblioforge.sources.works_client import Service


class Stub:
    """A works service on the loopback that answers by rules: key -> list of statuses to give before a record."""

    def __init__(self):
        self.rules, self.served, self.asked, self.times, self.dead_after = {}, Counter(), Counter(), [], None
        stub = self

        class Handler(BaseHTTPRequestHandler):
            def do_GET(self):
                key = self.path.removeprefix("/works/")
                stub.asked[key] += 1
                stub.times.append(time.monotonic())
                if stub.dead_after is not None and sum(stub.served.values()) >= stub.dead_after:
                    self.send_error(403)
                    return
                rule = stub.rules.get(key, [])
                status = rule.pop(0) if rule else 200
                if status == "hang":
                    time.sleep(1.5)
                    return
                if status == "half":
                    self.send_response(200)
                    self.end_headers()
                    self.wfile.write(b'{"id": "')
                    return
                self.send_response(status)
                if status == 429:
                    self.send_header("Retry-After", "0")
                self.end_headers()
                if status == 200:
                    stub.served[key] += 1
                    n = key.rpartition("/")[2]
                    self.wfile.write(json.dumps({"id": f"https://x/W{n}", "doi": f"https://doi.org/10.1/{n}", "title": f"é {n}", "referenced_works": [f"https://x/W{n}0"]}).encode())

            def log_message(self, *args):
                pass

        self.server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
        threading.Thread(target=self.server.serve_forever, daemon=True).start()
        self.url = f"http://127.0.0.1:{self.server.server_port}/works/{{key}}"


@pytest.fixture()
def stub():
    s = Stub()
    yield s
    s.server.shutdown()


def dois(spark, n):
    return spark.createDataFrame([(f"https://doi.org/10.1/{i % n}",) for i in range(2 * n)] + [(None,), ("-",)], "doi string")


def test_answers_of_all_kinds(spark, stub, tmp_path):
    stub.rules = {"doi:10.1/1": [429, 429], "doi:10.1/2": ["hang"], "doi:10.1/3": [404], "doi:10.1/4": [503], "doi:10.1/5": ["half"], "doi:10.1/6": [400], "doi:10.1/7": [500] * 9}
    service = Service(stub.url, rate=1000, parallel=3, attempts=4, timeout=0.5, wait=0.01, chunk=3)
    folder = str(tmp_path / "works")
    failed = works_client.fetch_works(works_client.doi_keys(dois(spark, 12)), folder, service)
    assert sorted(failed) == [("doi:10.1/6", "doi:10.1/6: 400"), ("doi:10.1/7", "doi:10.1/7: 500")]
    works = tables.read_works(spark, folder)
    assert {r.work_id: (r.doi_norm, r.title) for r in works.collect()} == {f"W{n}": (f"10.1/{n}", f"é {n}") for n in range(12) if n not in (3, 6, 7)}
    assert {r.key for r in works_client.cited_keys(works).collect()} == {f"W{n}0" for n in range(12) if n not in (3, 6, 7)}
    asked = dict(stub.asked)
    # a later run asks for what failed alone
    stub.rules = {}
    assert works_client.fetch_works(works_client.doi_keys(dois(spark, 12)), folder, service) == []
    assert {k: n for k, n in (stub.asked - Counter(asked)).items()} == {"doi:10.1/6": 1, "doi:10.1/7": 1}
    assert set(stub.served.values()) == {1} and tables.read_works(spark, folder).count() == 11


def test_resumes_after_it_died(spark, stub, tmp_path):
    """A service that refuses half-way, then a run that is killed between chunks: no answered key is asked for again."""
    service = Service(stub.url, rate=1000, parallel=2, attempts=1, chunk=1)
    folder = str(tmp_path / "works")
    stub.dead_after = 9
    failed = works_client.fetch_works(works_client.doi_keys(dois(spark, 20)), folder, service)
    assert len(failed) >= 10 and sum(stub.served.values()) <= 10
    stub.dead_after = None
    assert works_client.fetch_works(works_client.doi_keys(dois(spark, 20)), folder, service) == []
    assert set(stub.served.values()) == {1} and len(stub.served) == 20
    # a task that is repeated, as when its executor is lost: its chunks are there
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"key": [f"doi:10.2/{i}" for i in range(4)]})
    run = works_client._fetched(folder, service)
    real, done = works_client.ask, []

    def dies(service, key, *a):
        if len(done) == 2:
            raise KeyboardInterrupt
        done.append(key)
        return real(service, key, *a)

    works_client.ask = dies
    try:
        with pytest.raises(KeyboardInterrupt):
            list(run(iter([batch])))
    finally:
        works_client.ask = real
    assert list(run(iter([batch]))) == [] and {k: n for k, n in stub.served.items() if "10.2" in k} == {f"doi:10.2/{i}": 1 for i in range(4)}


def test_rate_is_shared(spark, stub, tmp_path):
    service = Service(stub.url, rate=20, parallel=4)
    works_client.fetch_works(works_client.doi_keys(dois(spark, 24)), str(tmp_path / "works"), service)
    span = max(stub.times) - min(stub.times)
    assert len(stub.times) == 24 and (len(stub.times) - 4) / span <= 21


def test_waits_grow_up_to_a_bound(stub):
    stub.rules = {"x": [500, 500, 500, 500, 429]}
    waits = []
    assert works_client.ask(Service(stub.url, wait=1, longest_wait=4), "x", waits.append)["title"] == "é x"
    assert waits == [1, 2, 4, 4, 0]


def test_empty_keys(spark, stub, tmp_path):
    assert works_client.fetch_works(works_client.doi_keys(dois(spark, 1).where("doi = '-'")), str(tmp_path / "works"), Service(stub.url)) == []
    assert not stub.asked
