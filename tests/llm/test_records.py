"""Archives, conversations and runs of words against plain versions."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F, types as T

import __spark_entry__ as contract
from kinlink.llm import conversations as C, periodic, warc
from tests.conftest import rows


def read(spark, sf, table):
    return spark.read.parquet(f"{sf}/{table}.parquet")


# --- archives -----------------------------------------------------------------------------------

PAGES = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType()),
                      *(T.StructField(c, T.StringType()) for c in ("key", "row", "n", "payload", "place"))])
BIG, ODD = "<p>shared page</p>" * 20, "é" * 60


def pages_table(spark, some):
    return spark.createDataFrame([(i, u, h, *["x"] * 5) for i, u, h in some], PAGES)


AWKWARD_PAGES = [(3, "http://a/ b\r\nX: y", BIG), (2, "http://b", BIG), (2, "http://b", BIG), (2, None, BIG), (None, "http://c", BIG), (4, None, None), (5, "http://é", ""),
                 (6, "u", "short"), (7, "u", "short"), (8, "u", ODD), (9, "u", ODD), (10, "u", "WARC/1.0\r\nWARC-Type: response\r\n\r\n" * 5), (11, "u", "x" * 3_000_000),
                 (None, "n", "only here " * 20), (None, "n", "only here " * 20)]


def expected_pages(some):
    out, seen = [], {}
    for i, _, h in sorted(some, key=lambda r: (r[0] is None, r[0] or 0)):
        data = (h or "").encode()
        revisit = len(data) >= 100 and data in seen
        out.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", seen[data] if revisit else None))
        seen.setdefault(data, i)
    return sorted(out, key=repr)


@pytest.mark.parametrize("gzip", [True, False])
def test_pages_come_back(spark, gzip):
    records = warc.page_records(pages_table(spark, AWKWARD_PAGES).repartition(3))
    manifest = warc.write_archives(records, gzip=gzip, roll_bytes=10_000)
    back = warc.read_archives(manifest)
    assert rows(warc.page_digest(back)) == expected_pages(AWKWARD_PAGES)
    assert warc.quarantine(back).count() == 0
    assert manifest.agg(F.sum("n_records")).first()[0] == len(AWKWARD_PAGES)
    found = {r["key"]: r for r in warc.valid_records(back).where("key IN ('3', '5', '11')").collect()}
    assert found["3"]["target_uri"] == "http://a/%20b%0D%0AX:%20y" and found["5"]["target_uri"] == "http://%C3%A9"
    assert bytes(found["11"]["payload"]) == b"x" * 3_000_000 and found["3"]["payload"] is None
    ids = [r["record_id"] for r in back.collect()]
    assert len(set(ids)) == len(ids)
    assert {r["refers_to"] for r in back.where("record_type = 'revisit'").collect()} <= set(ids)


def test_no_pages(spark):
    back = warc.read_archives(warc.write_archives(warc.page_records(pages_table(spark, AWKWARD_PAGES).where("false"))))
    assert back.count() == 0


def test_many_copies_of_one_page(spark):
    """A page that a third of all rows share is joined by the broadcast, the others by their digests."""
    some = [(i, "u", BIG if i % 3 == 0 else ODD + str(i // 4)) for i in range(6000)]
    digest = warc.page_digest(warc.read_archives(warc.write_archives(warc.page_records(pages_table(spark, some)))))
    assert rows(digest) == expected_pages(some)


def plain_record(key, text, kind="resource", version=b"WARC/1.0", digest=True):
    lines = [b"WARC-Type: " + kind.encode(), b"WARC-Record-ID: <urn:x:%d>" % key, b"WARC-Date: 2020-01-01T00:00:00Z", b"X-Record-Key: %d" % key,
             b"Content-Length: %d" % len(text)]
    if digest:
        lines.append(b"WARC-Block-Digest: sha256:" + hashlib.sha256(text).hexdigest().encode())
    return version + b"\r\n" + b"\r\n".join(lines) + b"\r\n\r\n" + text + b"\r\n\r\n"


def salvaged(data):
    events = list(warc.walk(warc.Tape(data)))
    outer = [(e.offset, e.offset + e.length) for e in events if e.inner is None or e.reason is None]
    covered = sorted(set(outer))
    assert covered == [] and not data or covered[0][0] == 0 and covered[-1][1] == len(data)
    assert all(a[1] == b[0] for a, b in zip(covered, covered[1:]))       # records and gaps cover the file, once
    return [int(e.headers["x-record-key"]) for e in events if e.reason is None], [(e.offset, e.length, e.reason) for e in events if e.reason is not None]


@pytest.mark.parametrize("gzip", [True, False])
def test_damage_costs_only_what_it_touches(gzip):
    """Every kind of damage to record 5 of 10; all the others come back, and the gap is the damaged record's bytes."""
    pack = warc.gzip_member if gzip else bytes
    parts = [pack(plain_record(k, b"text %d " % k * 50)) for k in range(10)]
    begin, size = sum(map(len, parts[:5])), len(parts[5])
    others = [k for k in range(10) if k != 5]
    assert salvaged(b"".join(parts)) == (list(range(10)), [])
    rng = random.Random(1)
    for _ in range(60):
        bad = bytearray(parts[5])
        at = rng.randrange(size) if gzip else rng.randrange(bytes(bad).index(b"\r\n\r\n"), size)    # plain headers have no check of their own
        bad[at] ^= 1 << rng.randrange(8)
        keys, gaps = salvaged(b"".join([*parts[:5], bytes(bad), *parts[6:]]))
        assert keys == others and [g[:2] for g in gaps] == [(begin, size)] or keys == list(range(10)) and not gaps    # a bit that no check covers
    for cut in (1, 3, size // 2, size - 1):
        keys, gaps = salvaged(b"".join([*parts[:5], parts[5][:cut], *parts[6:]]))
        assert keys == others and [g[:2] for g in gaps] == [(begin, cut)]
    keys, gaps = salvaged(b"".join([*parts[:5], b"noise WARC/1.0 and \x1f\x8b\x08 more", *parts[5:]]))
    assert keys == list(range(10)) and len(gaps) == 1
    keys, gaps = salvaged(b"".join(parts)[:-7])
    assert keys == list(range(9)) and [g[1] for g in gaps] == [len(parts[9]) - 7]
    assert salvaged(b"") == ([], []) and salvaged(b"nothing here") == ([], [(0, 12, "no version line")])


def test_records_inside_records_are_not_found_twice():
    inner = plain_record(7, b"nested")
    assert salvaged(plain_record(1, inner) + plain_record(2, b"x")) == ([1, 2], [])
    assert salvaged(warc.gzip_member(plain_record(1, warc.gzip_member(inner)))) == ([1], [])


def test_members_of_several_records():
    one, two, three = (plain_record(k, b"body" * k) for k in (1, 2, 3))
    keys, gaps = salvaged(warc.gzip_member(one + two[:-9] + three) + warc.gzip_member(one))
    assert keys == [1, 3, 1] and [g[2] for g in gaps] == ["no end of record where the length says"]


@pytest.mark.parametrize("change, reason", [
    ((b"WARC/1.0", b"WARC/x.0"), "no version line"), ((b"WARC-Date", b"WARC-Dats"), "no warc-date"), ((b"Content-Length: 4", b"Content-Length: q"), "content-length is no number"),
    ((b"body", b"bodY"), "block digest differs"), ((b"Content-Length: 4", b"Content-Length: 999"), "record longer than the archive"), ((b"WARC-Type:", b"WARC-Type "), "header line without a colon")])
def test_reasons(change, reason):
    bad = plain_record(1, b"body").replace(*change)
    keys, gaps = salvaged(bad + plain_record(2, b"next"))
    assert keys == [2] and [g[2] for g in gaps] == [reason]


def test_archives_of_a_folder(spark, folder):
    """Archives made elsewhere, one of them damaged: the log names file, place and reason."""
    good, text = plain_record(1, b"one"), plain_record(2, b"two " * 40_000)
    open(f"{folder}/a.warc", "wb").write(good + text[:-3] + plain_record(3, b"three"))
    open(f"{folder}/b.warc.gz", "wb").write(warc.gzip_member(good))
    open(f"{folder}/c.warc", "wb").close()
    back = warc.read_archives(warc.archives_in(spark, folder))
    assert sorted(r["key"] for r in warc.valid_records(back).collect()) == ["1", "1", "3"]
    [gap] = warc.quarantine(back).collect()
    assert gap["path"].endswith("a.warc") and (gap["offset"], gap["length"]) == (len(good), len(text) - 3)


def test_a_payload_that_is_not_what_its_digest_says(spark, folder):
    row = dict(record_type="response", record_id="<urn:x>", target_uri=None, payload_digest=hashlib.sha256(b"other").hexdigest(), payload=b"this", payload_bytes=4,
               key="1", refers_to=None, refers_to_key=None)
    open(f"{folder}/a.warc", "wb").write(warc.record_bytes(row, "2020-01-01T00:00:00Z"))
    back = warc.read_archives(warc.archives_in(spark, folder))
    assert [r["reason"] for r in back.collect()] == ["payload digest differs"]


# --- conversations ------------------------------------------------------------------------------

LANGUAGE = re.compile(r"(s?(ua)+)?")


def by_dynamic_program(turns):
    """Cheapest (cost, audit) over whole strings: every state after every turn, with insertions until nothing improves."""
    best = {0: (0, "")}
    for t in [*turns, None]:
        for _ in range(4):
            for s, (c, a) in list(best.items()):
                to = {0: 2, 1: 2, 2: 3, 3: 2}[s]
                best[to] = min(best.get(to, (c + 5, a + "I")), (c + 5, a + "I"))
        if t is None:
            return min(best[s] for s in (0, 3) if s in best)
        initial, fault = t
        new = {}
        def put(s, value):
            new[s] = min(new.get(s, value), value)
        for s, (c, a) in best.items():
            put(s, (c + 2, a + "D"))
            if fault in (0, 3):
                x = 5 if fault == 3 else 0
                to = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}.get((s, initial))
                if to is not None:
                    put(to, (c + x, a + "K"))
                put({0: 2, 1: 2, 2: 3, 3: 2}[s], (c + 1 + x, a + "R"))
        best = new


def by_trying_all(turns, inserts=2):
    """Cheapest (cost, audit) of all edits with up to two insertions at each place, from the definition."""
    places = [("",)] + [("K", "R", "D") if f in (0, 3) else ("D",) for _, f in turns]
    best = None
    for letters in itertools.product(*places[1:]):
        for counts in itertools.product(range(inserts + 1), repeat=len(turns) + 1):
            audit = "".join("I" * n + (letters[i] if i < len(turns) else "") for i, n in enumerate(counts))
            cost = 5 * sum(counts) + sum({"K": 0, "R": 1, "D": 2}[x] + (5 if f == 3 and x != "D" else 0) for x, (_, f) in zip(letters, turns))
            if best and (cost, audit) >= best:
                continue
            roles = [["u", "a"] if n is None else n for n in _outputs(letters, counts, turns)]
            if any(LANGUAGE.fullmatch("".join(x)) for x in itertools.product(*roles)):
                best = cost, audit
    return best


def _outputs(letters, counts, turns):
    for i, n in enumerate(counts):
        yield from [None] * n
        if i < len(turns) and letters[i] != "D":
            yield None if letters[i] == "R" else [turns[i][0]]


def derived(turns, piece):
    repair = C.Repair(piece)
    edits = [e for i, (initial, fault) in enumerate(turns) for e in repair.add(i, initial, f"t{i}", fault)]
    last, cost = repair.finish()
    return cost, "".join(e[0] for e in edits + last), edits + last


def test_lightest_derivations():
    rng = random.Random(5)
    for n in [0, 1, 2, 3] * 60:
        turns = [(rng.choice("suax"), rng.choice([0, 0, 1, 2, 3])) for _ in range(n)]
        expect = by_trying_all(turns)
        assert by_dynamic_program(turns) == expect
        assert derived(turns, 512)[:2] == expect


def test_derivation_piece_by_piece():
    """Pieces of any size give the edits of the whole; the result is in the language."""
    rng = random.Random(6)
    for k in range(300):
        kinds = rng.choice(["suax", "ua", "u", "a", "s", "us"])
        turns = [(rng.choice(kinds), rng.choice([0, 0, 0, 1, 2, 3] if k % 3 else [0, 3])) for _ in range(rng.randrange(90))]
        expect = by_dynamic_program(turns)
        for piece in (1, 2, 7, 512):
            cost, audit, edits = derived(turns, piece)
            assert (cost, audit) == expect
            assert LANGUAGE.fullmatch("".join(e[2][:1] for e in edits if e[0] != "D"))
            assert [e[1] for e in edits if e[0] != "I"] == list(range(len(turns)))


def test_a_long_conversation_is_forgotten_as_it_goes():
    rng, repair = random.Random(7), C.Repair(64)
    held = 0
    for i in range(20_000):
        repair.add(i, rng.choice(["user", "assistant", "system"]), "x", rng.choice([0, 0, 1, 3]))
        held = max(held, len(repair.turns))
    assert held < 400


WHITE = " \t\n\x0b\f\r"


def plain_summary(table):
    """The contract in plain Python, rows (conv_id, turn, role, text)."""
    out = []
    for conv in {r[0] for r in table}:
        kept = []
        for c, turn, role, text in table:
            if c != conv:
                continue
            key = f"{' ' if c is None else c}:{' ' if turn is None else turn}"
            kind = zlib.crc32(key.encode()) % 20
            role, text = (" " if x is None else x for x in (role, text))
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            kept += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, turns, illegal = set(), [], 0
        for i, (_, role, text) in enumerate(kept):
            stripped = text.rstrip(WHITE)
            fault = 1 if not stripped else 2 if (role, text) in seen else 3 if stripped[-1] not in ".!?" else 0
            seen.add((role, text))
            turns.append((role[:1], fault))
            illegal += i > 0 and kept[i - 1][1][:1] + role[:1] not in ("su", "ua", "au")
        numbers = {t for t, _, _ in kept if t is not None}
        cost, audit = by_dynamic_program(turns)
        state, at, lines = "", 0, []
        for x in audit:
            new = "assistant" if state == "u" else "user"
            role, text = (new, "") if x == "I" else kept[at][1:]
            at += x != "I"
            if x == "D":
                continue
            role = new if x == "R" else role
            state = role[:1]
            lines.append(f"{role}:{text}")
        faults = [f for _, f in turns]
        out.append((conv, max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0, *(faults.count(k) for k in (1, 2, 3)), illegal, cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


@pytest.mark.parametrize("size", ["0.001", "0.01"])
def test_conversations_of_the_table(spark, size):
    folder = f"/root/testdata/sf{size}"
    table = [tuple(r) for r in read(spark, folder, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert rows(contract.queries()["op12_conversation_repair"](spark, folder).select(*COLUMNS)) == plain_summary(table)


def test_awkward_conversations(spark):
    rng = random.Random(8)
    roles, texts = ["user", "assistant", "system", "", None, "User", "über", "tool"], ["", None, " \t", "A.", "A!\n", "é?", "no end", "x.\x0b", " ", "B.", "C."]
    table = [(rng.choice([None, *range(12)]), rng.choice([None, *range(-3, 30)]), rng.choice(roles), rng.choice(texts)) for _ in range(300)]
    table += [(99, i, "assistant" if i % 2 else "user", f"{i}.") for i in range(2000)]
    table += [(-1, t, "user", "gone.") for t in range(400) if zlib.crc32(f"-1:{t}".encode()) % 20 == 0]
    table += [(50, 1, "user", "same.")] * 3
    schema = "conv_id bigint, turn bigint, role string, text string, present string, fault string, kind string, copy string, earlier string"
    df = spark.createDataFrame([(*r, *["x"] * 5) for r in table], schema)
    damaged = C.with_damage(df)
    expect = plain_summary(table)
    for piece in (3, C.PIECE):
        assert rows(C.repair_summary(damaged, piece).select(*COLUMNS)) == expect
    assert C.repair_summary(C.with_damage(df.where("false"))).count() == 0
    edits = {}
    for r in sorted(C.repaired_turns(damaged, 5).collect(), key=lambda r: r["step"]):
        edits.setdefault(r["conv_id"], []).append(r["edit"])
    assert {c: "".join(edits.get(c, "")) for c in {r[0] for r in table}} == {r[0]: r[7] for r in expect}


def test_conversations_are_shuffled_once(spark, sf):
    plan = C.repair_summary(C.with_damage(read(spark, sf, "conversations")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Exchange") == 1


# --- runs of words ------------------------------------------------------------------------------

def plain_runs(words):
    """From the definition: for each period, stretches of words a period apart that are equal; a stretch counts for its smallest period."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        same = np.array([a == b for a, b in zip(words, words[q:])], np.int8) if not isinstance(words, np.ndarray) else (words[:-q] == words[q:]).astype(np.int8)
        step = np.diff(np.concatenate([[0], same, [0]]))
        for a, b in zip(np.flatnonzero(step == 1).tolist(), np.flatnonzero(step == -1).tolist()):
            if b - a + q >= max(6, 4 * q):
                found.setdefault((a, b - a + q), q)
    return sorted((s, length, q) for (s, length), q in found.items())


def test_runs_of_words():
    rng = random.Random(9)
    for k in range(400):
        n = rng.randrange(120)
        words = [rng.randrange(rng.choice([1, 2, 3])) for _ in range(n)]
        if k % 2 and n:
            a, p = rng.randrange(n), rng.randrange(1, 20)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
        half = rng.randrange(n + 1)
        for ends in ([n] * n, [half] * half + [n] * (n - half)):
            expect = plain_runs(words) if ends[:1] == [n] else plain_runs(words[:half]) + [(s + half, l, q) for s, l, q in plain_runs(words[half:])]
            got = periodic.find_runs(np.array(words, np.int64), np.array(ends, np.int64))
            assert list(map(tuple, got.tolist())) == expect


def plain_digest(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    number = {w: k for k, w in enumerate(dict.fromkeys(words))}
    runs = plain_runs(np.array([number[w] for w in words], np.int64))
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    drop = set()
    for s, length, q in runs:
        drop.update(range(s + q, s + length))
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in drop)), n)


def test_runs_of_the_table(spark, sf):
    docs = [tuple(r) for r in read(spark, sf, "documents").select("doc_id", "text").collect()]
    got = rows(contract.queries()["op13_periodic_runs"](spark, sf))
    assert got == sorted((plain_digest(*d) for d in docs), key=repr)
    assert sum(r[1] > 0 for r in got) >= 10


def test_runs_of_awkward_documents(spark, awkward, nothing):
    docs = [tuple(r) for r in awkward.select("doc_id", "text").collect()]
    docs += [(k, "a b " * 40 + "  c\x0bc\fc\rc c\tc c") for k in range(40)] + [(77, "w " * 30_000), (78, None), (79, "a a a a a"), (80, "a a a a a a")]
    more = awkward.sparkSession.createDataFrame(docs, "doc_id bigint, text string").withColumns({c: F.lit("x") for c in ("runs", "words", "h", "n", "best")})
    assert rows(periodic.digest(periodic.word_runs(periodic.with_planted_period(more)))) == sorted((plain_digest(*d) for d in docs), key=repr)
    assert periodic.digest(periodic.word_runs(periodic.with_planted_period(nothing))).count() == 0
    [kept] = periodic.word_runs(more.where("doc_id = 80")).collect()
    assert kept["collapsed"] == "a" and [tuple(r) for r in kept["runs"]] == [(0, 6, 1)]
