from __future__ import annotations

import base64
import hashlib
from collections import Counter

import pytest

from strata.llm import warc
from strata.session import scratch_dir

HTML = [
    "<p>one</p>",
    "<p>one</p>",
    "",
    None,
    "body\r\n\r\nWARC/1.1\r\nContent-Length: 99\r\n\r\nforged",
    "\r\n\r\n",
    "Ünïcode 🦆",
    "x" * 300_000,
    "x" * 300_000,
    "<p>one</p>",
]


def pages(spark):
    rows = [(n, f"http://e.com/{n}" if n % 4 else None, html) for n, html in enumerate(HTML)]
    rows += [(9, "http://e.com/9", "<p>one</p>"), (None, "u\r\nv", "lonely")]
    docs = spark.createDataFrame(rows, "page_id long, url string, html string")
    return docs.repartition(3).selectExpr("*", "1 AS id", "2 AS sha", "3 AS first", "4 AS row")


def told(found):
    return Counter(
        (
            r.metadata.fields.get("capture-id"),
            r.payload_bytes,
            r.digest,
            r.type,
            r.origin and r.origin.get("capture-id"),
        )
        for r in found.collect()
    )


def expected(rows, least):
    sets, stored = {}, Counter()
    for id_, _, html in rows:
        sets.setdefault(html or "", []).append(id_)
    for html, ids in sets.items():
        payload = html.encode()
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        small = len(payload) < least
        top = max((i for i in ids if i is not None), default=None)
        kept = False
        for id_ in ids:
            first = small or id_ == top and not kept
            kept = kept or id_ == top
            name = None if id_ is None else str(id_)
            stored[
                name,
                len(payload),
                digest,
                "response" if first else "revisit",
                None if first else str(top),
            ] += 1
    return stored


@pytest.mark.parametrize("least", [0, 100])
def test_round_trip(spark, least):
    docs = pages(spark)
    rows = [(r.page_id, r.url, r.html) for r in docs.collect()]
    found = warc.archived(docs, least)
    assert told(found) == expected(rows, least)
    responses = found.filter("type = 'response'").collect()
    payloads = {r.metadata.fields.get("capture-id"): bytes(r.payload).decode() for r in responses}
    assert all(payloads.get(str(n), HTML[n]) == (HTML[n] or "") for n in range(len(HTML)))
    assert all(r.request.target_uri == r.target_uri for r in responses)


def test_plain_archives_in_many_files(spark):
    docs = pages(spark)
    path = scratch_dir(spark, "warc-test")
    warc.write_archives(warc.captures(docs), path, per_file=1, compression=None)
    rows = [(r.page_id, r.url, r.html) for r in docs.collect()]
    found = warc.resolve_revisits(warc.assemble(warc.read_records(spark, path)))
    assert told(found) == expected(rows, 0)


def test_records_of_a_foreign_archive():
    block = b"HTTP/1.1 200 OK\r\n\r\nhello"
    record = (
        b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <a>\r\nContent-Length: "
        + str(len(block)).encode()
        + b"\r\n\r\n"
        + block
        + b"\r\n\r\n"
    )
    other = record.replace(b"response", b"request ").replace(b"<a>", b"<b>")
    found = list(warc.parse(record + other))
    assert [r["type"] for r in found] == ["response", "request"]
    assert found[0]["payload"] == b"hello" and found[1]["payload"] is None


def test_transactions_need_no_order_and_no_partner(spark):
    made = [
        ("<m>", "metadata", "<r>", {"capture-id": "1"}),
        ("<r>", "response", None, {}),
        ("<lonely>", "response", None, {}),
        ("<q>", "request", "<r>", {}),
        ("<stray>", "request", "<gone>", {}),
    ]
    rows = [(i, t, c, None, "u", None, None, f, None) for i, t, c, f in made]
    found = warc.assemble(spark.createDataFrame(rows, warc.RECORD)).collect()
    by_id = {r.record_id: r for r in found}
    assert by_id.keys() == {"<r>", "<lonely>"}
    assert by_id["<r>"].request.record_id == "<q>"
    assert by_id["<r>"].metadata.fields == {"capture-id": "1"}
    assert by_id["<lonely>"].request is None


def test_empty(spark):
    docs = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.archived(docs).count() == 0
