import hashlib
import io

import pyarrow as pa
import pytest
import zstandard

from utterflow.llm import warc
from utterflow.plans.storage import new_folder

LONG = "<html>" + "x" * 200 + "é</html>"


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)


def rows_of(found):
    return {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found.collect()}


def expected(rows):
    payloads = {i: (h or "").encode() for i, _, h in rows}
    out = {}
    for i, data in payloads.items():
        first = min(k for k, d in payloads.items() if d == data)
        revisit = len(data) >= 100 and i != first
        digest = hashlib.sha256(data).hexdigest()
        out[i] = (len(data), digest, "revisit" if revisit else "response", first if revisit else None)
    return out


ROWS = [
    (1, "http://a/1", LONG), (2, "http://a/2", "short"), (3, None, "short"), (4, "http://a/4", LONG),
    (5, "http://b/\r\nX: y", None), (6, "", ""), (7, "http://a/1", LONG), (8, "http://c", "a\r\n\r\nb" * 30),
    (9, "http://c", "\0" * 99), (10, "http://c", "\0" * 99), (11, "u", "\0" * 100), (12, "u", "\0" * 100),
]


def test_records_come_back(spark):
    assert rows_of(warc.archived(pages(spark, ROWS))) == expected(ROWS)


def test_payloads_come_back(spark):
    folder = new_folder(spark, "warc")
    index = warc.write_archives(pages(spark, ROWS), folder)
    found = {r.page_id: r for r in warc.read_archives(index, folder, with_payload=True).collect()}
    for i, url, html in ROWS:
        if found[i].record_type == "response":
            assert bytes(found[i].payload) == (html or "").encode()
        else:
            assert found[i].payload is None
        assert found[i].url == (None if url is None else url.replace("\r\n", "%0D%0A"))


def test_bundles_are_plain_zstandard_and_seekable(spark):
    folder = new_folder(spark, "warc")
    rows = [(i, "u", f"page {i} " + "text " * (i % 50)) for i in range(200)]
    index = warc.write_archives(pages(spark, rows).coalesce(1), folder).collect()
    fs, path = warc._filesystem(folder)
    with fs.open_input_file(f"{path}/{index[0].bundle}") as file:
        reader = warc.SeekableReader(file)
        whole = b"".join(reader.frame(k) for k in range(len(reader.sizes)))
        file.seek(0)
        packed = file.read()
    assert whole.count(b"WARC/1.1\r\n") == 200
    stream = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(packed), read_across_frames=True)
    assert stream.read() == whole


def test_frames_hold_whole_records():
    out = io.BytesIO()
    out.close = lambda: None
    writer = warc.SeekableWriter(out, frame_bytes=100)
    places = [writer.add(bytes([65 + i]) * (30 * i)) for i in range(8)]
    writer.close()
    reader = warc.SeekableReader(_Bytes(out.getvalue()))
    for i, (frame, offset) in enumerate(places):
        assert reader.frame(frame)[offset : offset + 30 * i] == bytes([65 + i]) * (30 * i)
    assert len(reader.sizes) > 3


class _Bytes:
    def __init__(self, data):
        self.data = data

    def size(self):
        return len(self.data)

    def read_at(self, n, at):
        return self.data[at : at + n]


def test_a_bundle_that_is_none_and_a_wrong_digest_fail():
    with pytest.raises(ValueError):
        warc.SeekableReader(_Bytes(b"\0" * 40))
    record = warc.record_bytes(1, "u", b"payload", "0" * 64, None)
    headers, block = warc.parsed_record(record, 0)
    with pytest.raises(ValueError):
        warc._record_row(pa.scalar(1), headers, block, False)
    with pytest.raises(ValueError):
        warc.parsed_record(record[:-5], 0)


def test_repeated_rows_missing_ids_and_no_rows(spark):
    rows = [(1, "u", LONG), (1, "u", LONG), (None, "u", LONG), (2, "u", LONG)]
    found = warc.archived(pages(spark, rows)).collect()
    kinds = sorted((r.page_id or 0, r.record_type, r.refers_to or 0) for r in found)
    assert kinds == [(0, "revisit", 1), (1, "response", 0), (1, "response", 0), (2, "revisit", 1)]
    assert warc.archived(pages(spark, [])).count() == 0


def test_extra_columns_of_clashing_names(spark):
    table = pages(spark, ROWS[:3]).selectExpr("*", "1 AS digest", "2 AS payload", "3 AS refers_to")
    assert rows_of(warc.archived(table)) == expected(ROWS[:3])
