"""Archives of other writers: many records a member."""

import base64
import hashlib
import random

from rollout_quality.llm import warc


def _record(i):
    # Text that hardly shrinks, so that damage hits one record.
    block = random.Random(i).randbytes(3000).hex().encode()
    return warc.record("response", i, "http://a", warc._sha1(block), len(block), block)


def _ids(found):
    return [int(f.headers["warc-record-id"][10:-1]) for f in found if f.kind == "response"]


def test_member_with_a_damaged_record_keeps_the_others():
    parts = [_record(i) for i in range(9)]
    parts[4] = parts[4].replace(b"WARC-Block-Digest: sha1:", b"WARC-Block-Digest: sha1:X")
    found = list(warc.salvage(warc.member(b"".join(parts)) + warc.member(_record(9))))
    assert _ids(found) == [0, 1, 2, 3, 5, 6, 7, 8, 9]
    assert [f.kind for f in found].index("gap") == 4 and found[4].note == "digest"


def test_cut_off_member_keeps_its_beginning():
    whole = warc.member(b"".join(_record(i) for i in range(9)))
    found = list(warc.salvage(warc.member(_record(20)) + whole[: len(whole) * 2 // 3]))
    ids = _ids(found)
    assert ids[:6] == [20, 0, 1, 2, 3, 4] and ids[1:] == list(range(len(ids) - 1))
    assert found[-1].kind == "gap" and found[-1].note == "member"
    # The same with other members behind it.
    ids = _ids(warc.salvage(whole[: len(whole) * 2 // 3] + warc.member(_record(21)) + warc.member(_record(22))))
    assert ids[:5] == [0, 1, 2, 3, 4] and ids[-2:] == [21, 22]


def test_member_with_a_wrong_checksum_keeps_records_with_a_digest():
    whole = bytearray(warc.member(b"".join(_record(i) for i in range(5))))
    whole[-6] ^= 0x55
    found = list(warc.salvage(bytes(whole) + warc.member(_record(7))))
    assert _ids(found) == [0, 1, 2, 3, 4, 7] and {f.note for f in found[:5]} == {"member"}
    assert [f.kind for f in found].count("gap") == 1


def _http(name, digest, body, block_digest=None, head=b""):
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n" + head + b"\r\n" + body
    lines = ["WARC/1.0", "WARC-Type: response", f"WARC-Record-ID: <urn:uuid:{name}>", f"WARC-Target-URI: http://{name}",
             f"WARC-Payload-Digest: {digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    lines += [f"WARC-Block-Digest: {block_digest(block)}"] if block_digest else []
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def test_standard_responses_are_read(spark, tmp_path):
    body = b"<p>a\r\n\r\nb</p>"
    sha1, sha256 = hashlib.sha1(body), hashlib.sha256(body)
    base32 = "sha1:" + base64.b32encode(sha1.digest()).decode()
    rows = [
        _http("a", base32, body, warc._sha1),
        _http("b", "sha1:" + sha1.hexdigest(), body, lambda x: "sha256:" + hashlib.sha256(x).hexdigest()),
        _http("c", "SHA-256:" + base64.b32encode(sha256.digest()).decode(), body, lambda x: "md5:" + hashlib.md5(x).hexdigest()),
        _http("d", "xxh3:0011", body, lambda x: "blake9:00"),
        _http("e", base32, b"%x\r\n%s\r\n0\r\n\r\n" % (len(body), body), head=b"Transfer-Encoding: chunked\r\n"),
        _http("wrong", base32, body + b"!"), _http("odd", "sha1:zz", body), _http("f", base32, body, lambda x: "sha1:" + "0" * 40),
    ]
    (tmp_path / "crawl-00.warc.gz").write_bytes(b"".join(map(warc.member, rows)))
    got = warc.read_archives(spark, str(tmp_path)).toPandas()
    assert got["kind"].tolist() == ["response"] * 5 + ["gap"] * 3
    read = got[:5]
    assert [bytes(x) for x in read["payload"]] == [body] * 5 and read["bytes"].tolist() == [len(body)] * 5
    assert read["digest"].tolist() == [sha1.hexdigest(), sha1.hexdigest(), sha256.hexdigest(), "xxh3:0011", sha1.hexdigest()]
    assert read["note"].tolist()[3] == "block digest unchecked; payload digest unchecked" and read["note"].isna().sum() == 4
