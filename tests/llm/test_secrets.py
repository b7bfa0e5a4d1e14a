"""Spans against the standard library's matcher, the battery on drawn strings, and redaction."""

import random
import re

from helpers import documents, prose

from ledgerline.llm import secret_scan
from ledgerline.llm.queries import QUERIES

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
BASE64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"


def brute(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def spans_of(frame):
    return {r["doc_id"]: [(s["start"], s["kind"], s["stop"]) for s in r["spans"]] for r in secret_scan.scan_secrets(frame).collect()}


def test_base_spans(spark):
    texts = [
        'é😀 password = "hunter22" and TOKEN:abc', "secret:token:abcdefgh", "password=token=abcdef", "passwd:  'a.b-c_d'", "AKIA" + "Q" * 16 + " AKIAQ", "xAKIA" + "A" * 40, "0123456789abcdef" * 3, "deadbeef" * 3 + "g" + "cafe" * 5,
        "API_KEY='AKIA" + "Z9" * 10 + "' apikey:0123456789abcdef01234567", "tokentoken=abcdefg", 'secret"  =  "x/y+z=="', "",
    ]
    rnd = random.Random(4)
    parts = ["password", "Secret", "token", "api_key", ":", "=", " ", '"', "'", "abcdef", "0a1b2c3d", "AKIA", "ABCDEFGH12", "\n", "é", "-._"]
    texts += ["".join(rnd.choice(parts) for _ in range(40)) for _ in range(300)]
    got = spans_of(documents(spark, [(i, t, "a") for i, t in enumerate(texts)]))
    for i, t in enumerate(texts):
        assert [s for s in got[i] if s[1] < 3] == brute(t)


def test_random_strings_are_found_and_words_are_not(spark):
    rnd = random.Random(8)
    keys = ["".join(rnd.choice(BASE64) for _ in range(rnd.randint(44, 60))) for _ in range(60)]
    words = [prose(100 + i, 20).replace(" ", "")[:50] for i in range(300)]
    patterns = ["ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", "aB3" * 15, "abcdefghijklmnopqrstuvwxyz" * 2]
    rows = [(i, f"x {k} y", "a") for i, k in enumerate(keys + words + patterns)]
    got = spans_of(documents(spark, rows))
    found = [any(s == (2, 3, 2 + len(k)) for s in got[i]) for i, k in enumerate(keys + words + patterns)]
    assert sum(found[:60]) >= 50 and not any(found[60:])


def test_redaction(spark):
    text = "é password=abcdefghij then AKIA" + "Q" * 16 + " end"
    rows = {r["doc_id"]: r for r in secret_scan.redact(documents(spark, [(1, text, "a"), (2, "clean", "a"), (3, None, "b")])).collect()}
    assert rows[1]["text"] == "é [SECRET] then [SECRET] end" and rows[1]["n_chars"] == len(rows[1]["text"])
    assert rows[2]["text"] == "clean" and rows[3]["text"] is None
    both = "token=" + "0123456789abcdef" * 2 + "=="
    assert secret_scan.redact(documents(spark, [(1, "a " + both + " b", "a")])).first()["text"] == "a [SECRET] b"


def test_query(spark, folder):
    import hashlib

    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for r in QUERIES["op3_secret_scan"](spark, folder).collect():
        want = brute(texts[r["doc_id"]])
        listed = ",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in want)
        assert r["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(k == n for _, k, _ in want) for n in range(3))


def test_every_encoding_at_short_lengths(spark):
    """Even draws of every encoding among three times as many ordinary strings; digits alone give the least evidence."""
    rnd = random.Random(5)
    ordinary = {
        "decimal": lambda n: "".join(f"2024{m:02d}{m + 9:02d}000{m}00" for m in rnd.sample(range(1, 10), 5))[:n], "hex_lower": lambda n: "".join(rnd.choice(["deadbeef", "facade", "000000", "cafe", "decade", "123456", "added"]) for _ in range(n))[:n],
        "base64url": lambda n: "-".join(prose(rnd.randint(1, 10**6), n).split(" "))[:n], "base64": lambda n: "".join(w.capitalize() for w in prose(rnd.randint(1, 10**6), n).split(" "))[:n],
    }
    ordinary |= {"base36_lower": lambda n: prose(rnd.randint(1, 10**6), n).replace(" ", "")[:n]}
    ordinary |= {"hex_upper": lambda n: ordinary["hex_lower"](n).upper(), "base32": lambda n: ordinary["base36_lower"](n).upper(), "base36_upper": lambda n: (ordinary["base36_lower"](n - 4) + "1998").upper()}
    keys, rows = {}, []
    for name, symbols in secret_scan.ENCODINGS.items():
        for n in (20, 24, 32, 40):
            for i in range(160):
                if i < 40:
                    keys[len(rows)] = (name, n)
                rows.append((len(rows), f"see {''.join(rnd.choice(symbols) for _ in range(n)) if i < 40 else ordinary[name](n)} there", "a"))
    got = spans_of(documents(spark, rows))
    found = {k: sum((4, 3, 4 + k[1]) in got[i] for i, key in keys.items() if key == k) for k in set(keys.values())}
    assert all(n >= (20 if name == "decimal" else 32) for (name, _), n in found.items()), found
    false = [i for i in got if i not in keys and any(s[1] == 3 for s in got[i])]
    assert len(false) <= 0.02 * sum(found.values()), [rows[i][1] for i in false]


def test_keys_glued_to_paths_and_prefixes(spark):
    rnd = random.Random(12)
    draw = lambda symbols, n: "".join(rnd.choice(symbols) for _ in range(n))
    url = secret_scan.ENCODINGS["base64url"]
    rows, want = [], {}
    for i in range(120):
        plus, low = draw(BASE64, 18) + rnd.choice("+/") + draw(BASE64, 21), draw(url, 18) + rnd.choice("-_") + draw(url, 21)
        before, key, after = [
            ("https://host/v1/keys/", low, "/show"), ("sk_live_", plus, " end"), ("key-", plus, ", next"), ("/usr/local-share/", draw(secret_scan.ENCODINGS["hex_lower"], 40), "/my-file_name"),
        ][i % 4]
        rows.append((i, f"é {before}{key}{after}", "a"))
        want[i] = (2 + len(before), 2 + len(before) + len(key))
    words = [(1000 + i, "see " + "".join(w + rnd.choice("/-_+") for w in prose(i, 12).split(" ")) + " there", "a") for i in range(300)]
    got = spans_of(documents(spark, rows + words))
    held = [any(s[1] == 3 and s[0] <= want[i][0] and s[2] >= want[i][1] for s in got[i]) for i in want]
    exact = [(want[i][0], 3, want[i][1]) in got[i] for i in want]
    assert min(sum(held[n::4]) for n in range(4)) >= 26 and sum(exact) >= 90, [sum(x[n::4]) for x in (held, exact) for n in range(4)]
    assert not any(s[1] == 3 for i, _, _ in words for s in got[i])
    for spans in got.values():
        mine = [s for s in spans if s[1] == 3]
        assert not any(a != b and b[0] <= a[0] and a[2] <= b[2] for a in mine for b in mine)
