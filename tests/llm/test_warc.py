import base64
import gzip
import hashlib
import io
from collections import defaultdict

import pytest

from caremesa.llm import warc

ROWS = [
    (1, "http://a b", "x"), (2, None, "x"), (3, "u", None), (4, "u", ""), (4, "u", ""), (None, "z", "y"), (None, "z", "y"),
    (5, "q", "é<p>"), (5, "q2", "é<p>"), (6, "q", "long " * 100_000), (7, "r", "\r\n\r\nWARC/1.1"),
]


def brute(rows):
    groups = defaultdict(list)
    for i, (page_id, url, page) in enumerate(rows):
        groups[(page or "").encode()].append((page_id is not None, page_id or 0, url is not None, url or "", i))
    result = []
    for payload, members in groups.items():
        top, sha = max(members), base64.b32encode(hashlib.sha1(payload).digest()).decode()
        for member in members:
            first = member[-1] == min(m[-1] for m in members if m[:4] == top[:4])
            top_id = rows[top[-1]][0]
            result.append((rows[member[-1]][0], len(payload), sha, "response" if first else "revisit", None if first else top_id))
    return result


def frame(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "'clash' as payload", "1 as n")


def test_archive_equals_brute_force(spark):
    found = [tuple(row)[:5] for row in warc.archive(frame(spark, ROWS)).collect()]
    assert sorted(found, key=str) == sorted(brute(ROWS), key=str)
    assert warc.archive(frame(spark, ROWS).limit(0)).count() == 0


def test_small_payloads_may_be_exempt(spark):
    found = {tuple(row)[:1] + (row["record_type"],) for row in warc.archive(frame(spark, ROWS), 2).collect()}
    assert (1, "response") in found and (2, "response") in found and (5, "revisit") in found


def test_members_are_ordinary_gzip_and_read_in_small_steps():
    contents = [warc.record("response", i, "u", bytes([65 + i]) * i, i, warc.digest(bytes([65 + i]) * i), None) for i in range(50)]
    file = b"".join(map(warc.member, contents))
    assert gzip.decompress(file) == b"".join(contents)
    for size in (1, 7, 1 << 16):
        assert list(warc.members(io.BytesIO(file), size)) == contents
    parsed = warc.parse(contents[3])
    assert parsed["payload"] == b"DDD" and parsed["payload_bytes"] == 3


def test_damage_is_noticed():
    content = warc.record("response", 1, None, b"abc", 3, warc.digest(b"abc"), None)
    for broken in (content.replace(b"abc", b"abd"), content[:-1], content.replace(b"WARC/", b"WORC/")):
        with pytest.raises(ValueError):
            warc.parse(broken)
    with pytest.raises(ValueError):
        list(warc.members(io.BytesIO(warc.member(content)[:-4])))


def test_several_archives_of_a_task(spark):
    folder = warc.shared_folder(spark)
    manifest = warc.write(warc.records(frame(spark, ROWS)).coalesce(1), folder, archive_bytes=300)
    assert manifest.count() > 1
    assert warc.read(manifest, folder).count() == len(ROWS)
