"""Pages from a paginated service as a Spark data source.

``spark.read.format("page_api")`` follows continuation tokens, one chain of requests for each start.
A start (a namespace, a first title) is a partition, so a service that can be entered at many places is
read by many tasks; one chain is sequential by its nature, and a task that is lost asks again from its
start.  Rows leave a task as they come; no chain is held.

Options: ``starts``, a JSON list of parameters to begin with (default one, empty); ``cap``, most requests a
chain (200); ``url`` of the service, or ``saved``, a folder of saved responses (see ``save_responses``);
``agent`` and ``timeout``.
"""

from __future__ import annotations

import json
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Parameters of every request, and the most requests of one chain.
PARAMETERS = {"action": "query", "format": "json", "generator": "allpages", "gapnamespace": 0, "gaplimit": 50, "prop": "revisions", "rvprop": "content", "rvslots": "main"}
CAP = 200
SCHEMA = "title string, text string, start int, request int, place int"


class ApiError(Exception):
    """The service failed, or gave nothing that can be used."""


def http(url: str, agent: str, timeout: float) -> Callable[[dict], dict]:
    """Asks the service itself."""

    def get(parameters: dict) -> dict:
        request = urllib.request.Request(f"{url}?{urllib.parse.urlencode(parameters)}", headers={"User-Agent": agent})
        try:
            with urllib.request.urlopen(request, timeout=timeout) as answer:
                body = answer.read()
        except urllib.error.HTTPError as e:
            raise ApiError(f"the service answered {e.code} to {e.url}") from None
        except urllib.error.URLError as e:
            raise ApiError(f"the service cannot be reached: {e.reason}") from None
        try:
            return json.loads(body)
        except ValueError:
            raise ApiError("the service's answer is no JSON") from None

    return get


def saved(folder: str, start: int) -> Callable[[dict], dict]:
    """Answers from responses saved in the order of their requests; reads on and never back, so none is held."""
    import pyarrow.fs
    import pyarrow.parquet as pq

    files, base = pyarrow.fs.FileSystem.from_uri(f"{folder}/start={start}")
    parts = sorted(f.path for f in files.get_file_info(pyarrow.fs.FileSelector(base)) if f.path.endswith(".parquet"))

    def rows() -> Iterator[tuple[str, str]]:
        for path in parts:
            with files.open_input_file(path) as f:
                for batch in pq.ParquetFile(f).iter_batches(16, columns=["token", "payload"]):
                    yield from zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())

    reading = rows()

    def get(parameters: dict) -> dict:
        wanted = parameters.get("gapcontinue", "")
        for token, payload in reading:
            if token == wanted:
                return json.loads(payload)
        raise ApiError(f"no response to {wanted!r} was saved")

    return get


def chain(get: Callable[[dict], dict], first: dict, cap: int = CAP) -> Iterator[tuple[str, str, int, int]]:
    """``(title, text, request, place)`` of all requests from one start; pages without a revision or content are left out."""
    parameters = PARAMETERS | first
    for request in range(cap):
        payload = get(parameters)
        # failures come with a good status and no token, and would else look like the end
        if "error" in payload:
            error = payload["error"]
            code, info = (error.get("code", "unknown"), error.get("info", error)) if isinstance(error, dict) else ("unknown", error)
            raise ApiError(f"API error [{code}]: {info}")
        for place, page in enumerate(payload.get("query", {}).get("pages", {}).values()):
            for revision in (page.get("revisions") or [])[:1]:
                text = revision.get("slots", {}).get("main", {}).get("*")
                if text is not None:
                    yield page["title"], text, request, place
        if not payload.get("continue"):
            return
        parameters = PARAMETERS | first | payload["continue"]
    raise ApiError(f"the service still wants to continue after {cap} requests: its token does not advance")


class Start(InputPartition):
    """One chain of requests."""

    def __init__(self, number: int, first: dict):
        super().__init__(number)
        self.number, self.first = number, first


class PageReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = dict(options)

    def partitions(self) -> list[Start]:
        return [Start(k, first) for k, first in enumerate(json.loads(self.options.get("starts", "[{}]")))]

    def read(self, partition: Start) -> Iterator[tuple]:
        o = self.options
        get = saved(o["saved"], partition.number) if "saved" in o else http(o["url"], o.get("agent", "lodestone"), float(o.get("timeout", "30")))
        for title, text, request, place in chain(get, partition.first, int(o.get("cap", CAP))):
            yield title, text, partition.number, request, place


class PageApi(DataSource):
    @classmethod
    def name(cls) -> str:
        return "page_api"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> PageReader:
        if ("saved" in self.options) == ("url" in self.options):
            raise ValueError("page_api needs either a url or a folder of saved responses")
        return PageReader(self.options)


def fetched_pages(spark: SparkSession, **options: str) -> DataFrame:
    """``title, text`` of a service; of a title that comes again the later text stays."""
    spark.dataSource.register(PageApi)
    rows = spark.read.format("page_api").options(**options).load()
    return rows.groupBy("title").agg(F.max_by("text", F.struct("start", "request", "place")).alias("text"))


def save_responses(responses: DataFrame, folder: str) -> None:
    """Writes ``responses(start, request, token, payload)``, what the service said to each request, for ``saved``."""
    ordered = responses.repartition("start").sortWithinPartitions("start", "request")
    ordered.select("start", "token", "payload").write.mode("errorifexists").partitionBy("start").parquet(folder)
