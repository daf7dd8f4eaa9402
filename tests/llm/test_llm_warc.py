import gzip
import hashlib

import pytest
from pyarrow import fs

from oracle_compare import compare, duck
from seqlab.llm import warc
from seqlab.llm.common import work_folder
from seqlab.llm.queries import ORACLE, QUERIES

PAGES = "page_id long, url string, html string, id string, shard string"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", None) for i, u, h in rows], PAGES)


ROWS = [(3, "http://a/é x", "<p>one</p>"), (1, None, "<p>one</p>"), (2, "u", ""), (5, "u", None), (7, "v\r\nX: y", "z"),
        (9, "w", "a\r\n\r\nb" * 5000), (4, "u", "<p>four</p>"), (4, "u", "<p>four</p>"), (None, "n", "<p>one</p>"),
        (None, "n", "alone"), (-6, "m", "minus")]


def expected(rows, least=0):
    key = lambda i: (i is None, i or 0)
    first = {}
    for i, _, h in rows:
        first[h or ""] = min(first.get(h or "", (True, 0)), key(i))
    out = []
    for i, _, h in rows:
        data = (h or "").encode()
        of = first[h or ""]
        revisit = len(data) >= least and of < key(i)
        out.append((i, len(data), warc.sha1_base32(data), "revisit" if revisit else "response",
                    of[1] if revisit else None))
    return sorted(out, key=str)


def read(df):
    return sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"])
                   for r in df.collect()), key=str)


@pytest.mark.parametrize("options", [{}, {"roll_bytes": 1}, {"shard_bytes": 700}, {"least": 5}])
def test_round_trip(spark, options):
    got = warc.archived(pages(spark, ROWS), **options)
    assert read(got) == expected(ROWS, options.get("least", 0))
    payloads = {r["page_id"]: bytes(r["payload"]).decode() for r in got.collect() if r["record_type"] == "response"}
    assert payloads[9] == ROWS[5][2] and payloads[-6] == "minus"


def files_of(folder):
    store, root = fs.FileSystem.from_uri(folder)
    found = store.get_file_info(fs.FileSelector(root))
    return {f.base_name: store.open_input_stream(f.path, compression=None).read() for f in found
            if f.base_name.endswith(".gz")}


def test_same_files_in_every_run(spark):
    a, b = work_folder(spark, "warc-a"), work_folder(spark, "warc-b")
    m = warc.write_archives(pages(spark, ROWS), a, shard_bytes=700, roll_bytes=300)
    warc.write_archives(pages(spark, ROWS[::-1]).repartition(3), b, shard_bytes=700, roll_bytes=300)
    assert files_of(a) == files_of(b) and len(files_of(a)) > 3
    assert {(r["name"], r["sha256"]) for r in m.collect()} == {
        (n, hashlib.sha256(d).hexdigest()) for n, d in files_of(a).items()}
    text = gzip.decompress(next(iter(files_of(a).values())))
    assert text.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")


def test_damage_is_found(spark):
    good = warc.record(1, "u", b"payload", None)
    assert warc.parse_record(good)["payload"] == b"payload"
    with pytest.raises(ValueError):
        warc.parse_record(good.replace(b"payload\r\n", b"paXload\r\n"))


def test_empty_table(spark):
    assert warc.archived(pages(spark, [])).count() == 0


def test_query_equals_sql(spark, sf_small):
    res = compare(spark, "op5_warc_sharded", QUERIES["op5_warc_sharded"], ORACLE["op5_warc_sharded"], sf_small,
                  duck(sf_small))
    assert res["status"] == "OK", res


def test_shards_follow_bytes_not_ids(spark):
    """An outlying id, ids over the whole range, and many pages without an id."""
    low, high = -(1 << 63), (1 << 63) - 2
    for ids in ([*range(200), 10 ** 15], [low, *range(200), high], [1, 2, *[None] * 200]):
        folder = work_folder(spark, "warc-test")
        rows = [(i, f"http://x/{k}", f"{k:05d}" * 20, "", "") for k, i in enumerate(ids)]
        manifest = warc.write_archives(spark.createDataFrame(rows, PAGES), folder, shard_bytes=6000).collect()
        assert len(manifest) >= 15 and max(r["records"] for r in manifest) <= 20
        got = [(r["page_id"], r["url"], bytes(r["payload"]).decode()) for r in warc.read_archives(spark, folder).collect()]
        key = lambda r: (r[0] is None, r[0] or 0, r[1])
        assert sorted(got, key=key) == sorted([r[:3] for r in rows], key=key)
