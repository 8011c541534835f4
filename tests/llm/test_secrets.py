"""Secret scans: base patterns by hand, nested layers, cycles, odd inputs."""

import base64
import bz2
import gzip
import hashlib
import json
import lzma
import os
import re
import subprocess
import sys
import zlib
from urllib.parse import quote, quote_plus

from pyspark.sql import functions as F

from cumulus.llm import secrets as S

KEY = "password = hunter2hunter2"


def plain_base(text):
    """The contract's patterns, one after the other, without shortcuts."""
    out = []
    for m in re.finditer(r"""((?:p|P)(?:a|A)(?:s|S)(?:s|S)(?:(?:w|W)(?:o|O)(?:r|R)(?:d|D)|(?:w|W)(?:d|D))
        |[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*
        ["']?([A-Za-z0-9+/_.=-]+)""", text, re.X):
        if len(m[2]) >= 8:
            out.append((m.start(), 0, f"assign:{m.start()}:{m.end()}"))
    for k, p, n in ((1, "access:AKIA[A-Z0-9]+", 16), (2, "hex:[0-9a-f]+", 32)):
        name, p = p.split(":")
        for m in re.finditer(p, text):
            if len(m[0]) >= n:
                out.append((m.start(), k, f"{name}:{m.start()}:{m.end()}"))
    return ",".join(x for _, _, x in sorted(out))


def test_base_spans():
    for text in ["", KEY, "a" * 31 + " " + "0f" * 16, "AKIA" + "B" * 12, "AKIABBB", "é" + KEY,
                 "token: secret: abcdefgh12", "API_KEY='abcdefgh' apikey=short", "paſsword=abcdefgh",
                 "passwd=" + "ab" * 20, "xAKIA" + "Z9" * 20 + "f" * 40]:
        assert S.listed(S.findings(text)[0]) == plain_base(text), text


def test_layers_are_unwrapped_and_mapped():
    b64 = base64.b64encode
    for outer in (quote(KEY), "".join(f"\\u{ord(c):04x}" for c in KEY), b64(KEY.encode()).decode(),
                  b64(zlib.compress(KEY.encode())).decode(), b64(gzip.compress(KEY.encode())).decode(),
                  b64(b64(quote(KEY).encode())).decode(), quote(b64(KEY.encode()).decode() + "=="),
                  b64(gzip.compress(zlib.compress(b64(KEY.encode())))).decode(),
                  "".join(f"\\x{ord(c):02x}" for c in KEY), "".join(f"&#{ord(c)};" for c in KEY)):
        text = f"some ünicode words {outer} and more"
        base, spans, _ = S.findings(text)
        added = set(spans) - set(base)
        assert added and not base, outer
        for i, kind, j in added:
            assert kind == "assign" and text[i:j] in outer and i >= 19
        assert "hunter2" not in S.redact(text)


def test_base64_that_is_no_whole_run_of_text():
    b64 = base64.b64encode
    body = b64(KEY.encode() + b" and more").decode()
    packed = b64(gzip.compress(KEY.encode())).decode()
    noise = hashlib.sha512(b"x").digest() * 3

    def wrapped(data, width):
        s = b64(data).decode()
        return "\n".join(s[i:i + width] for i in range(0, len(s), width))
    for token in (body, packed):
        for prefix in ("https://ex.org/cb/", "data/", "cfg_", "a/b/c/", "x-y-"):
            text = f"see {prefix}{token} ok"
            spans = S.findings(text)[1]
            assert [k for _, k, _ in spans] == ["assign"], text
            i, _, j = spans[0]
            assert text.index(token) - 3 <= i < j <= len(text) - 3
    for width in (64, 76):
        for data in (b"x" * 40 + b" " + KEY.encode() + b" tail" * 20,
                     zlib.compress(noise + KEY.encode() + noise), gzip.compress(noise + KEY.encode())):
            for text in (wrapped(data, width), wrapped(data, width).replace("\n", "\r\n  ")):
                assert "assign" in [k for _, k, _ in S.findings(f"key: {text}\n")[1]]
    for data in (KEY.encode("utf-16"), KEY.encode("utf-16-be"), b"\xe9t\xe9 " + KEY.encode(),
                 gzip.compress(KEY.encode("utf-16-le")), gzip.compress(b"a") + gzip.compress(KEY.encode()),
                 bz2.compress(b"a") + bz2.compress(KEY.encode()),
                 lzma.compress(b"a") + lzma.compress(KEY.encode())):
        assert [k for _, k, _ in S.findings(b64(data).decode())[1]] == ["assign"], data


def test_compressed_bytes_in_escapes():
    for pack in (zlib.compress, gzip.compress, bz2.compress, lzma.compress):
        data = pack(KEY.encode())
        for enc in (quote(data), "".join(f"%{c:02x}" for c in data), repr(data)[2:-1],
                    "".join(f"\\x{c:02x}" for c in data)):
            text = f"go {enc} now {'word ' * 30}"
            spans = S.findings(text)[1]
            assert {k for _, k, _ in spans} == {"assign"}, (pack, enc)
            assert (3, "assign") in [s[:2] for s in spans] and max(s[2] for s in spans) <= 3 + len(enc)


def test_percent_span_is_exact():
    text = "go password%3Dhunter2hunter2 now"
    assert S.listed(S.findings(text)[1]) == "assign:3:28"


def test_unicode_run_with_control_characters():
    for inner in (f"{KEY}\ntoken=abcdefgh12", f"\t{KEY}\u00a0", f"{KEY}\x00\x07", f"\u2028{KEY}\r\n"):
        run = "".join(f"\\u{ord(c):04x}" for c in inner)
        assert "assign" in [k for _, k, _ in S.findings(f"a {run} b")[1]]
        assert S.redact(f"a {run} b") .count("[assign]") >= 1
    lone = "".join(f"\\u{ord(c):04x}" for c in KEY) + "\\ud800"
    assert [k for _, k, _ in S.findings(lone)[1]] == ["assign"]


def test_cycles_and_repeats_end(monkeypatch):
    assert S.findings("%2525252525" * 50)[1] == []
    token = base64.b64encode(KEY.encode()).decode()
    assert len(S.findings(f"{token} {token}")[1]) == 2

    def itself(token):  # a token that opens as a text holding that token
        return f"{KEY} {token}"
    monkeypatch.setattr(S, "_open", itself)
    assert [k for _, k, _ in S.findings("A" * 20)[1]] == ["assign"]


def test_bomb_is_left_closed_and_counted(monkeypatch):
    monkeypatch.setattr(S, "MAX_LAYER", 1000)
    bomb = base64.b64encode(zlib.compress(b"a" * 5000)).decode()
    assert S.findings(bomb) == ([], [], 1)


def test_a_closed_stream_hides_nothing_beside_it(monkeypatch):
    monkeypatch.setattr(S, "MAX_LAYER", 1 << 16)
    big, small = (quote(zlib.compress(x)) for x in (b"a " * (1 << 16), KEY.encode()))
    for text in (f"x {big} y {small} z", f"{small} {big}", f"{big} plain {KEY}"):
        base, spans, closed = S.findings(text)
        assert {k for _, k, _ in spans} == {"assign"} and closed >= 1
        assert "hunter2" not in S.redact(text) and not set(S.findings(small)[0])
    tokens = [base64.b64encode(zlib.compress(x)).decode() for x in (b"a " * (1 << 16), KEY.encode())]
    assert [k for _, k, _ in S.findings(" ".join(tokens))[1]] == ["assign"]


def test_layers_of_many_chunks_are_read_to_their_end(monkeypatch):
    monkeypatch.setattr(S, "CHUNK", 10_000)
    monkeypatch.setattr(S, "OVERLAP", 1000)
    for place in range(9_900, 10_100, 7):     # also across the end of a chunk
        data = b"word " * (place // 5) + b" " * (place % 5) + KEY.encode() + b" tail" * 9000
        for pack in (zlib.compress, gzip.compress, bz2.compress, lzma.compress):
            found = S.findings(base64.b64encode(pack(data)).decode())
            assert [k for _, k, _ in found[1]] == ["assign"] and not found[2], (place, pack)
    members = b"".join(gzip.compress(b"word " * 500) for _ in range(20)) + gzip.compress(KEY.encode())
    assert {k for _, k, _ in S.findings(base64.b64encode(members).decode())[1]} == {"assign"}
    nested = gzip.compress(zlib.compress(b"word " * 5000 + KEY.encode() + b" end" * 3000))
    assert {k for _, k, _ in S.findings(quote(nested))[1]} == {"assign"}


def test_form_encoding_and_strings_within_strings():
    for text in (quote_plus(KEY), f"a=1&q={quote_plus('x ' + KEY)}&z=%20", "password+%3D+hunter2hunter2"):
        assert [k for _, k, _ in S.findings(text)[1]] == ["assign"] and "hunter2" not in S.redact(text)
    inner = {"password": "hunter2hunter2"}
    for _ in range(4):
        text = json.dumps({"a": inner} if isinstance(inner, dict) else inner)
        assert "assign" in [k for _, k, _ in S.findings(text)[1]], text
        assert "hunter2" not in S.redact(text)
        inner = json.dumps(inner)
    text = json.dumps({"log": f"line\n{KEY}\nline"})
    assert "hunter2" not in S.redact(f"say {text}")


def test_a_small_token_takes_little_memory():
    """In a process of its own: 48 KB of base64 that unpack to 32 MB."""
    code = ("import base64, resource, sys, zlib; sys.path.insert(0, sys.argv[1])\n"
            "from cumulus.llm import secrets as S\n"
            "before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss\n"
            "found = S.findings(base64.b64encode(zlib.compress(b'a' * (32 << 20))).decode())\n"
            "assert {k for _, k, _ in found[1]} == {'hex'} and not found[2]\n"
            "print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)")
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    out = subprocess.run([sys.executable, "-c", code, root], capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    assert int(out.stdout) < 300


def test_frame(spark):
    rows = [(1, None), (2, ""), (3, KEY), (3, KEY), (None, KEY), (5, "x" * 300_000 + " " + KEY)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("spans", F.lit("a"))
    got = df.select("doc_id", S.scanned("text").alias("f"), S.redacted("text").alias("t")).collect()
    assert [r["f"]["base"] for r in got] == ["", ""] + ["assign:0:25"] * 3 + ["assign:300001:300026"]
    assert [tuple(r["t"]) for r in got][:4] == [(None, None), ("", 0), ("[assign]", 8), ("[assign]", 8)]
    assert df.limit(0).select(S.scanned("text")).count() == 0


def test_query_equals_plain_base(spark):
    from cumulus.llm.queries import op6_secret_scan
    sf = "/root/testdata/sf0.01"
    docs = dict(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    got = op6_secret_scan(spark, sf).collect()
    assert len(got) == len(docs)
    for r in got:
        base = plain_base(docs[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        assert set(filter(None, base.split(","))) <= set(r["spans"].split(","))
        assert r["n_hex"] == base.count("hex:")
