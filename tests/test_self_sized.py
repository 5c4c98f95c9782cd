"""Frames and epochs against readers that go from front to back."""

import collections
import random
import struct

import pytest
from pyspark.sql import functions as F

from tallyforge.plans.fixpoints import word_frames
from tallyforge.queries import QUERIES
from tallyforge.sources.self_sized import byte_at, datagram_size, epochs, frames, industrial_size, number, observations
from tests.test_queries import SF


def cut(rnd, data):
    out = []
    while data:
        n = rnd.choice([1, 1, 2, 3, 9, 40, 300])
        out.append(data[:n])
        data = data[n:]
    return out


def packets(spark, streams, seed):
    rnd = random.Random(seed)
    rows = []
    for k, data in streams.items():
        for i, p in enumerate(cut(rnd, data)):
            rows.append((k, 2 * i, bytearray(p), "x"))
            if rnd.random() < 0.2:
                rows.append((k, 2 * i + 1, rnd.choice([None, bytearray()]), "x"))
    rnd.shuffle(rows)
    return spark.createDataFrame([*rows, (None, 0, bytearray(b"a"), "x"), (1, None, bytearray(b"a"), "x")], "stream int, seq long, data binary, head string").drop("head")


def test_frames_across_packets(spark):
    rnd = random.Random(1)
    streams, want = {}, {}
    for k in range(12):
        data, out = b"", []
        for i in range(rnd.randint(1, 60)):
            pdu = bytes(rnd.choices(range(4), k=rnd.choice([1, 2, 5, 253])))
            out.append((len(data), i, "whole", i))
            data += struct.pack(">HHHB", i, 0, len(pdu) + 1, 7) + pdu
        if k % 3 == 1:
            data = data[:-1]
            out[-1] = (*out[-1][:2], "truncated", out[-1][3])
        if k % 3 == 2:
            out.append((len(data), len(out), "malformed", None))
            data += struct.pack(">HHHB", 1, 5, 3, 7) + b"abc"
        streams[k], want[k] = data, out
    found = frames(packets(spark, streams, 2), ["stream"], "seq", "data", header=8, size=industrial_size)
    got = collections.defaultdict(list)
    for r in found.withColumn("transaction", number(byte_at(F.col("head"), 0, 2))).orderBy("stream", "record").collect():
        got[r.stream].append((r.place, r.record, r.state, r.transaction if r.state != "malformed" else None))
    # a reply of one byte is eight bytes in all; frames whose head is cut off at the end begin no frame
    assert {k: v for k, v in got.items() if k % 3 != 1} == {k: v for k, v in want.items() if k % 3 != 1}
    for k in range(1, 12, 3):
        assert got[k][:-1] == want[k][:-1] and got[k][-1][2] in ("truncated", "malformed")


def test_datagrams(spark):
    rnd = random.Random(3)
    data, want = b"", []
    for i in range(200):
        body = rnd.choice([b"CON0", b"RAW0", b"NME0"]) + bytes(rnd.choices(range(256), k=rnd.randint(0, 90)))
        want.append((len(data), len(body) + 8, body[:4].decode()))
        data += struct.pack("<i", len(body)) + body + struct.pack("<i", len(body))
    found = frames(packets(spark, {1: data}, 4), ["stream"], "seq", "data", header=8, size=datagram_size(["CON0", "RAW0", "NME0"], 1 << 20))
    kind = F.decode(byte_at(F.col("head"), 4, 4), "ISO-8859-1")
    assert [tuple(r) for r in found.orderBy("record").select("place", "size", kind).collect()] == want
    assert found.where("state <> 'whole'").count() == 0


def test_frames_of_odd_tables(spark):
    one = lambda h: number(h) + 1
    found = frames(packets(spark, {5: bytes([0, 0, 3, 9, 9, 9, 2, 1, 1])}, 5), ["stream"], "seq", "data", header=1, size=one)
    assert [(r.place, r.size, r.state) for r in found.where("stream = 5").orderBy("record").collect()] == [(0, 1, "whole"), (1, 1, "whole"), (2, 4, "whole"), (6, 3, "whole")]
    assert frames(packets(spark, {}, 6).where("stream is null"), ["stream"], "seq", "data", header=1, size=one).count() == 0


def test_frames_across_blocks(spark, monkeypatch):
    monkeypatch.setattr("tallyforge.sources.self_sized.BLOCK", 16)
    rnd = random.Random(7)
    streams = {k: bytes(rnd.choices(range(m), k=rnd.choice([1, 16, 17, 700]))) for k, m in enumerate([1, 2, 40] * 4)}
    found = frames(packets(spark, streams, 8), ["stream"], "seq", "data", header=2, size=lambda h: number(h) % 64 + 1)
    got, want = collections.defaultdict(list), {}
    for r in found.orderBy("stream", "record").collect():
        got[r.stream].append((r.place, r.size, r.state, r.head and bytes(r.head)))
    for k, data in (streams | {None: b"a"}).items():
        at, out = 0, []
        while at < len(data) and k is not None:
            head = data[at : at + 2]
            if len(head) < 2:
                out.append((at, None, "malformed", None))
                break
            n = int.from_bytes(head) % 64 + 1
            out.append((at, n, "whole" if at + n <= len(data) else "truncated", head))
            at += n
        want[k] = out
    assert got == {k: v for k, v in want.items() if v}


def plain(lines, codes):
    pos, number_of, out, states = 0, 0, [], []
    per = (len(codes) + 4) // 5
    while pos < len(lines):
        line = lines[pos]
        if not line.strip():
            pos, number_of = pos + 1, number_of + 1
            continue
        try:
            flag, count = int(line[28:29]), int(line[29:32])
        except ValueError:
            return out, [*states, "malformed"]
        if flag > 6:
            return out, [*states, "malformed"]
        more = max(0, -(-count // 12) - 1) if flag in (0, 1, 6) else 0
        size = 1 + (count if 2 <= flag <= 5 else more + count * per)
        if pos + size > len(lines):
            return out, [*states, "truncated"]
        states.append("whole")
        if flag in (0, 1):
            for s in range(count):
                text = "".join(x.ljust(80) for x in lines[pos + 1 + more + s * per : pos + 1 + more + (s + 1) * per])
                out += [(number_of, s, c, float(f)) for i, c in enumerate(codes) if (f := text[i * 16 : i * 16 + 14].strip())]
        pos, number_of = pos + size, number_of + 1
    return out, states


@pytest.mark.parametrize("n_codes", [1, 5, 7])
def test_epochs(spark, n_codes):
    rnd = random.Random(n_codes)
    codes = [f"C{i}" for i in range(n_codes)]
    per = (n_codes + 4) // 5

    def satellites(n):
        for _ in range(n):
            fields = ["" if rnd.random() < 0.2 else f"{rnd.uniform(-9, 9e6):14.3f}" for _ in codes]
            text = "".join(f"{f:14s} 1" for f in fields).ljust(80 * per)
            yield from (text[80 * k : 80 * k + 80].rstrip() for k in range(per))

    files = {}
    for name, tail in (("a", []), ("b", ["", " 20  1  1  0  0  0.0000000  9  1"]), ("c", [" 20  1  1  0  0  0.0000000  0 30", "x"]), ("d", ["no epoch at all, whatever it may say here"])):
        lines = []
        for _ in range(rnd.randint(5, 25)):
            flag, n = rnd.choice([0, 0, 0, 1, 3, 4, 6]), rnd.choice([0, 1, 3, 12, 13, 30])
            lines.append(f"{' 20  1  1  0  0  0.0000000':26s}  {flag}{n:3d}" + "G01" * (min(n, 12) if flag in (0, 1, 6) else 0))
            if 2 <= flag <= 5:
                lines += [f" 20  1  1  0  0  0.0000000  0  {rnd.randint(1, 9)} says a comment"] * n
            else:
                lines += [" " * 32 + "G02" * 12] * max(0, -(-n // 12) - 1) + list(satellites(n))
            lines += [""] * rnd.choice([0, 0, 1])
        files[name] = lines + tail
    table = spark.createDataFrame([(p, i, x) for p, own in files.items() for i, x in enumerate(own, 1)], "path string, line long, value string").repartition(5)
    got = collections.defaultdict(list)
    for r in epochs(table, n_codes).orderBy("path", "record").collect():
        got[r.path].append(r.state)
    assert got == {p: plain(own, codes)[1] for p, own in files.items()}
    values = collections.defaultdict(list)
    for r in observations(table, codes).collect():
        values[r.path].append((r.record, r.satellite, r.code, r.value))
    assert {p: sorted(v) for p, v in values.items()} == {p: sorted(v) for p, own in files.items() if (v := plain(own, codes)[0])}


def word_frames_by_hand(turns):
    out = []
    for conv in sorted({c for c, _, s in turns if s}):
        words = [(t, n) for c, t, s in sorted(turns, key=lambda r: (r[1] is None, r[1] or 0)) if c == conv and s for n in s]
        place = record = 0
        while place < len(words):
            turn, n = words[place]
            met = {t for t, _ in words[place : place + n]} - {None}
            out.append((conv, record, place, n, "truncated" if place + n > len(words) else "whole", turn, len(met) > 1))
            place, record = place + n, record + 1
    return out


@pytest.mark.parametrize("block", [3, 8, 1 << 16])
def test_word_frames(spark, block):
    r = random.Random(5)
    turns = [(c, t, bytes(r.randint(1, 7) for _ in range(r.choice([0, 1, 2, 9, 40])))) for c in range(12) for t in range(c)]
    turns += [(20, 1, b""), (20, 2, None), (21, 1, bytes([1, 2])), (21, 1, bytes([1, 2])), (21, 2, bytes([1, 7])), (21, None, bytes([3]))]
    got = word_frames(spark.createDataFrame(turns, "conv_id long, turn int, sizes binary"), block)
    assert sorted(tuple(x) for x in got.select("conv_id", "record", "place", "size", "state", "turn", "crosses").collect()) == word_frames_by_hand(turns)


def test_chained_frames_make_no_row_a_word(spark):
    df = QUERIES["chained_frames"](spark, SF)
    assert "explode" not in df._jdf.queryExecution().toString()
