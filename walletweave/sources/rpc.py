"""JSON-RPC source: a small client with retries, and a Spark data source over height ranges.

Executors fetch; the driver plans. Each input partition is a range of heights, read block by
block with receipts in batches. A failed partition is read again by Spark as a whole, and since
facts are deduplicated by identity that is harmless.
"""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Fixed values.
TAGS = ("latest", "safe", "finalized")
RETRY_STATUS = frozenset({429, *range(500, 600)})
RETRY_CODES = range(-32099, -31999)


class RpcError(Exception):
    """A call that cannot succeed by trying again."""


class RetryableRpcError(RpcError):
    """A call that may succeed later."""


class NotFoundError(RpcError):
    """The node has no such block or receipt."""


def block_tag(block: int | str) -> str:
    """A height as hex, or one of the known tags."""
    if isinstance(block, bool) or (isinstance(block, int) and block < 0):
        raise ValueError("a height is a non-negative integer")
    if isinstance(block, int):
        return hex(block)
    if block in TAGS:
        return block
    raise ValueError(f"unknown block tag: {block}")


def http_post(url: str, body: bytes, timeout: float) -> tuple[int, bytes]:
    request = urllib.request.Request(url, body, {"Content-Type": "application/json"})
    try:
        with urllib.request.urlopen(request, timeout=timeout) as response:
            return response.status, response.read()
    except urllib.error.HTTPError as e:
        return e.code, e.read()
    except OSError as e:
        raise RetryableRpcError(str(e)) from e


class RpcClient:
    """Calls one endpoint; ``post`` and ``sleep`` can be replaced in tests."""

    def __init__(self, url: str, timeout: float = 20.0, attempts: int = 3, backoff: float = 0.25, batch_size: int = 20,
                 post: Callable[[str, bytes, float], tuple[int, bytes]] = http_post, sleep: Callable[[float], None] = time.sleep):
        if attempts < 1 or batch_size < 1:
            raise ValueError("attempts and batch_size must be positive")
        self.url, self.timeout, self.attempts, self.backoff = url, timeout, attempts, backoff
        self.batch_size, self.post, self.sleep, self.last_id = batch_size, post, sleep, 0

    def _retried(self, once: Callable):
        for n in range(self.attempts):
            try:
                return once()
            except RetryableRpcError:
                if n + 1 == self.attempts:
                    raise
                self.sleep(self.backoff * 2**n)

    def _send(self, payload):
        status, body = self.post(self.url, json.dumps(payload).encode(), self.timeout)
        if status in RETRY_STATUS:
            raise RetryableRpcError(f"HTTP status {status}")
        if status >= 400:
            raise RpcError(f"HTTP status {status}")
        try:
            return json.loads(body)
        except ValueError as e:
            raise RpcError("the answer is not JSON") from e

    def _request(self, method: str, params: list) -> dict:
        self.last_id += 1
        return {"jsonrpc": "2.0", "id": self.last_id, "method": method, "params": params}

    @staticmethod
    def _result(answer):
        if not isinstance(answer, dict):
            raise RpcError("the answer is not an object")
        if error := answer.get("error"):
            code = error.get("code") if isinstance(error, dict) else None
            raise (RetryableRpcError if code in RETRY_CODES else RpcError)(f"RPC error: {error}")
        if "result" not in answer:
            raise RpcError("the answer has no result")
        return answer["result"]

    def call(self, method: str, params: list):
        def once():
            request = self._request(method, params)
            answer = self._send(request)
            if isinstance(answer, dict) and answer.get("id") != request["id"]:
                raise RpcError("the answer is to another request")
            return self._result(answer)

        return self._retried(once)

    def chain_id(self) -> int:
        return int(self.call("eth_chainId", []), 16)

    def block(self, block: int | str, full: bool = True) -> dict:
        found = self.call("eth_getBlockByNumber", [block_tag(block), full])
        if found is None:
            raise NotFoundError(f"block {block} not found")
        return found

    def receipt(self, tx_hash: str) -> dict:
        found = self.call("eth_getTransactionReceipt", [tx_hash])
        if found is None:
            raise NotFoundError(f"receipt {tx_hash} not found")
        return found

    def receipts(self, hashes: list[str]) -> list[dict]:
        """Receipts in the order asked for; a batch is retried as a whole."""
        out: list[dict] = []
        for i in range(0, len(hashes), self.batch_size):
            out += self._retried(lambda part=hashes[i:i + self.batch_size]: self._batch(part))
        return out

    def _batch(self, hashes: list[str]) -> list[dict]:
        requests = [self._request("eth_getTransactionReceipt", [h]) for h in hashes]
        answers = self._send(requests)
        if not isinstance(answers, list):
            raise RpcError("the answer to a batch is not a list")
        by_id = {a.get("id"): a for a in answers if isinstance(a, dict)}
        out = []
        for request, h in zip(requests, hashes, strict=True):
            if request["id"] not in by_id:
                raise RpcError(f"no answer for receipt {h}")
            result = self._result(by_id[request["id"]])
            if result is None:
                raise NotFoundError(f"receipt {h} not found")
            out.append(result)
        return out

    def logs(self, start: int, end: int, address: str | None = None, topics: list | None = None) -> list[dict]:
        query = {"fromBlock": block_tag(start), "toBlock": block_tag(end)}
        query |= {"address": address} if address else {}
        query |= {"topics": topics} if topics else {}
        return self.call("eth_getLogs", [query])

    def heads(self) -> dict[str, int]:
        return {t: int(self.block(t, False)["number"], 16) for t in TAGS}


class HeightRange(InputPartition):
    def __init__(self, start: int, end: int):
        self.start, self.end = start, end


class BlockReader(DataSourceReader):
    def __init__(self, options: dict):
        self.url = options["url"]
        self.start, self.end = int(options["start"]), int(options["end"])
        self.per = int(options.get("blocksperpartition", 100))
        if not 0 <= self.start <= self.end:
            raise ValueError("0 <= start <= end is required")

    def partitions(self):
        return [HeightRange(a, min(self.end, a + self.per - 1)) for a in range(self.start, self.end + 1, self.per)]

    def read(self, partition: HeightRange) -> Iterator[tuple]:
        client = RpcClient(self.url)
        for height in range(partition.start, partition.end + 1):
            block = client.block(height)
            receipts = client.receipts([t["hash"] for t in block["transactions"]])
            yield height, json.dumps(block), json.dumps(receipts)


class BlockSource(DataSource):
    """``spark.read.format("evm_blocks")``: height, block and receipts as JSON text."""

    @classmethod
    def name(cls) -> str:
        return "evm_blocks"

    def schema(self) -> str:
        return "height bigint, block string, receipts string"

    def reader(self, schema) -> BlockReader:
        return BlockReader(self.options)
