import gzip
import hashlib
import re
import tempfile
import time
from itertools import combinations
from random import Random

import pytest
from pyspark.sql import functions as F

from matchlake.llm import url_rules, warc_audit
from matchlake.llm.common import stored
from matchlake.llm.queries import URL_RULES
from matchlake.session import shared_folder


def parts(url):
    match = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    return (re.sub("[A-Z]", lambda m: m[0].lower(), match[1]), match[2]) if match else ("", "")


def written(host, path):
    fits = [(len(h + p), h + p, v) for v, h, p in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


URLS = [
    "http://example.com/en/1", "https://WWW.Example.com/en/x.html?q=1#f", "http://www.example.com/de/", "http://a.net/es/1", "http://a.net/esx",
    "http://b.a.net/fr/", "http://com/", "http://xcom/", "http://a.com", "http://a.com?x=/en/", "no scheme", None, "", "://", "x://y://z/en/",
    "http://É.com/ñ\n2", "http://a.org/en/5", "http://a.org/fr/6", "http://a.com:80/", "HTTP://A.COM/" + "s/" * 20_000,
]


def test_hosts_paths_and_written_rules(frame):
    pages = frame([(n, u, "h", "v") for n, u in enumerate(URLS)], "page_id int, url string, host string, tokens string")
    got = {r["page_id"]: r for r in url_rules.judged(pages, URL_RULES).collect()}
    assert len(got) == len(URLS) and got[0]["tokens"] == "v"
    for n, url in enumerate(URLS):
        host, path = parts(url)
        rule, verdict = written(host, path)
        assert (got[n]["host"], got[n]["path"], got[n]["rule"]) == (host, path, rule), url
        assert got[n]["verdict"] == verdict if verdict else got[n]["verdict"] in ("allow", "block")


def brute_rules(bags, support, confidence):
    """All sure combinations of tokens, without those that a shorter one makes needless."""
    found = {}
    for tokens in {c for b, _ in bags for n in range(1, len(b) + 1) for c in combinations(b, n)}:
        with_ = [v for b, v in bags if set(tokens) <= set(b)]
        for verdict in set(with_):
            both = with_.count(verdict)
            if both / len(bags) >= support and both / len(with_) >= confidence:
                found[tokens, verdict] = both / len(with_)
    return {
        k: c
        for k, c in found.items()
        if not any(found.get((tuple(t for t in k[0] if t != x), k[1]), -1) >= c for x in k[0] if len(k[0]) > 1)
    }


def test_mined_rules_against_all_combinations(frame):
    bags = []
    for n in range(60):
        tokens = sorted({f"t{n % 3}", f"u{n % 4}", f"v{n % 5}", "all"})
        bags.append((tokens, "block" if n % 4 == 1 or (n % 3 == 0 and n % 5 == 2) else "allow"))
    rules = url_rules.mined_rules(frame(bags, "tokens array<string>, verdict string"), 0.05, 0.8).collect()
    got = {(tuple(r["antecedent"]), r["verdict"]): r["confidence"] for r in rules}
    assert got == pytest.approx(brute_rules(bags, 0.05, 0.8))


def test_rules_judge_the_urls_that_have_their_tokens(frame):
    pages = [(f"http://s{n}.net/{'es' if n % 2 else 'de'}/{n}",) for n in range(40)] + [(f"http://s{n}.com/de/{n}",) for n in range(40)]
    pages += [("http://other.org/es/77",), ("http://other.org/de/78",), ("http://other.org/xx",)]
    got = {r["url"]: r for r in url_rules.judged(frame(pages, "url string"), URL_RULES).collect()}
    assert got["http://other.org/es/77"]["verdict"] == "block" and got["http://other.org/es/77"]["mined"] == ["path:es"]
    assert got["http://other.org/de/78"]["verdict"] == "allow" and got["http://other.org/xx"]["mined"] in (None, ["path:xx"], ["depth:2"])


def test_a_hot_url_with_many_tokens(frame):
    """25 keys of one verdict; 25 more that both verdicts have in different sets, with one pair that tells."""
    keys = [f"key:{n:02}" for n in range(25)]
    bags = [(["hot", *keys], "block")] * 100 + [(sorted({f"t{n % 7}", f"u{n % 3}"}), "allow" if n % 3 else "block") for n in range(100)]
    start = time.monotonic()
    got = {(tuple(r["antecedent"]), r["verdict"]) for r in url_rules.mined_rules(frame(bags, "tokens array<string>, verdict string")).collect()}
    singles = {((t,), "block") for t in ("hot", "u0", *keys)} | {((t,), "allow") for t in ("u1", "u2")}
    pairs = brute_rules([b for b in bags if b[0][0] != "hot"], 0.01, 0.8)
    assert got == singles | set(pairs) and time.monotonic() - start < 60
    mixed = [([k for j, k in enumerate(keys) if j != n % 25], "block" if n % 2 else "allow") for n in range(500)]
    mixed += [(["a"], "block")] * 50 + [(["b"], "allow")] * 50 + [(["a", "b"], "allow")] * 50 + [(["a", "x"], "allow")] * 20
    found = url_rules.mined_rules(frame(mixed, "tokens array<string>, verdict string")).collect()
    assert (("a", "b"), "allow") not in {(tuple(r["antecedent"]), r["verdict"]) for r in found}  # b alone is as sure
    assert {(("b",), "allow"), (("x",), "allow")} <= {(tuple(r["antecedent"]), r["verdict"]) for r in found}
    assert time.monotonic() - start < 120


def test_rules_of_the_least_sure_of_many_tokens_and_of_doubles(frame):
    """p and q, the least sure of urls with 16 tokens, tell together; d has the labelled urls of c00."""
    bags = []
    for n in range(60):
        tokens = [f"c{j:02}" for j in range(14) if j != n % 15] + ["d"] * (n % 15 != 0) + ["p"] * (n % 4 < 2) + ["q"] * (n % 4 in (1, 2))
        bags += [(sorted(tokens), "block" if n % 4 == 1 or k < 4 else "allow") for k in range(10)]
    rules = url_rules.mined_rules(frame(bags, "tokens array<string>, verdict string")).collect()
    assert {(tuple(r["antecedent"]), r["verdict"]) for r in rules} == {(("p", "q"), "block")}
    bags = [(t, v) for t, v, n in ((["a", "b", "s"], "block", 40), (["a", "b"], "allow", 30), (["s"], "allow", 30)) for _ in range(n)]
    got = {(tuple(r["antecedent"]), r["verdict"]): r["confidence"] for r in url_rules.mined_rules(frame(bags, "tokens array<string>, verdict string")).collect()}
    assert got == brute_rules(bags, 0.005, 0.8) and {(("a", "s"), "block"), (("b", "s"), "block")} <= set(got)


def test_rules_of_random_urls_against_all_combinations(frame):
    random = Random(5)
    for confidence in (0.6, 0.75, 1.0):
        bags = []
        for _ in range(90):
            tokens = sorted({f"t{min(random.randrange(8), random.randrange(8))}" for _ in range(random.randrange(1, 7))})
            bags.append((tokens, random.choice(["allow", "block"] if "t1" in tokens else ["allow", "allow", "block", "other"])))
        rules = url_rules.mined_rules(frame(bags, "tokens array<string>, verdict string"), 0.02, confidence).collect()
        got = {(tuple(r["antecedent"]), r["verdict"]): r["confidence"] for r in rules}
        assert len(rules) == len(got) and got == pytest.approx(brute_rules(bags, 0.02, confidence))


def test_matching_by_the_index_against_all_rules(frame):
    names = [f"t{n}" for n in range(8)]
    rules = [(list(c), "block" if sum(map(ord, "".join(c))) % 2 else "allow", 0.9, 0.1) for n in (1, 2, 3) for c in combinations(names, n) if len("".join(c)) % 2 == 0 or c[0] == "t3"]
    index = url_rules.inverted_index(frame(rules, "antecedent array<string>, verdict string, confidence double, support double")).collect()
    assert sorted((r["antecedent"], r["verdict"]) for r in index) == sorted((r[0], r[1]) for r in rules)
    for url in combinations(names, 4):
        hit = sorted(r["antecedent"] for r in index if r["token"] in url and set(r["antecedent"]) <= set(url))
        assert hit == sorted(r[0] for r in rules if set(r[0]) <= set(url))


def test_without_labels_and_without_rows(frame):
    pages = frame([("http://a.org/x",)], "url string")
    assert url_rules.judged(pages, URL_RULES, default="block").first()["verdict"] == "block"
    assert url_rules.judged(pages.limit(0), URL_RULES).collect() == []


PAGES = [(n, f"http://a.org/{n}", f"<p>page {n}</p>" * (n % 9)) for n in range(300)] + [
    (300, None, None), (None, "x\r\ny", ""), (302, "u", "a\r\n\r\nWARC/1.0\r\n\r\nb"), (303, "u", "é日" * 100_000), (0, "http://a.org/0", ""),
]


def replica(spark, frame, pages, **options):
    path = shared_folder(spark, "warc")
    warc_audit.write_warc(frame([(*p, 1) for p in pages], "page_id long, url string, html string, file int").coalesce(2), path, **options)
    return path


def test_records_are_read_as_they_were_written(spark, frame):
    path = replica(spark, frame, PAGES, file_records=50)
    rows = warc_audit.scan_warc(spark, path).collect()
    assert len(rows) == len(PAGES) and len({r["file"] for r in rows}) >= 6
    records = spark.range(1).select(*[warc_audit.record_text(*[F.lit(v).cast("string") for v in p]) for p in PAGES]).first()
    assert sorted(r["sha256"] for r in rows) == sorted(hashlib.sha256((x + "\r\n\r\n").encode()).hexdigest() for x in records)
    for file in {r["file"] for r in rows}:
        own = sorted((r for r in rows if r["file"] == file), key=lambda r: r["ordinal"])
        assert [r["offset"] for r in own] == [sum(x["length"] for x in own[:k]) for k in range(len(own))]


def test_damage_is_located_and_nothing_else(spark, frame):
    damaged = [(p[0], p[1], p[2].replace("page", "paGe", 1)) if p[0] in (17, 19, 250) else p for p in PAGES]
    one, two = (replica(spark, frame, pages, file_records=70) for pages in (PAGES, damaged))
    found = warc_audit.audit(spark, one, two).where("status <> 'intact'").collect()
    assert sorted(r["record_id"] for r in found) == ["<urn:page:17>", "<urn:page:19>", "<urn:page:250>"]
    assert warc_audit.audit(spark, one, one).where("status = 'intact'").count() == len(PAGES)


def test_missing_and_added_records(spark, frame):
    one, two = (replica(spark, frame, pages, file_records=1000) for pages in (PAGES, PAGES[:-2]))
    status = {r["status"]: r["count"] for r in warc_audit.audit(spark, one, two).groupBy("status").count().collect()}
    back = {r["status"]: r["count"] for r in warc_audit.audit(spark, two, one).groupBy("status").count().collect()}
    assert status["missing"] == 2 == back["added"] and sum(status.values()) == len(PAGES) == sum(back.values())


def test_damage_inside_compressed_files_is_located(spark, frame):
    """One flipped bit, at several places, is one record; of a file that is cut off the rest is missing."""
    pages = [(n, f"http://a.org/{n}", "".join(f"<p>{(n * k * 7919) % 9973}</p>" for k in range(60))) for n in range(250)]
    one = replica(spark, frame, pages)
    files = spark.read.format("binaryFile").load(one).select("path", "content").collect()
    whole = sorted(((r["path"].rsplit("/", 1)[1], bytes(r["content"])) for r in files if r["content"]), key=lambda f: f[0])
    own = list(warc_audit.read_records(whole[0][1]))
    assert sum(len(list(warc_audit.read_records(c))) for _, c in whole) == 250 and gzip.decompress(whole[0][1]) == b"".join(r[1] for r in own)
    for at in range(40, len(whole[0][1]) - 40, len(whole[0][1]) // 150):
        content = bytearray(whole[0][1])
        content[at] ^= 16
        got = list(warc_audit.read_records(bytes(content)))
        assert len(got) == len(own) and sum(a[1] != b[1] for a, b in zip(own, got, strict=True)) <= 1, at
    def audited(content):
        folder = tempfile.mkdtemp(prefix="warc-")
        for name, kept in whole:
            with open(f"{folder}/{name}", "wb") as file:
                file.write(content if name == whole[0][0] else kept)
        found = warc_audit.audit(spark, one, folder).where("status <> 'intact'").groupBy("status").count()
        return {r["status"]: r["count"] for r in found.collect()}
    middle = len(whole[0][1]) // 2 + 30
    content = bytearray(whole[0][1])
    content[middle] ^= 1
    assert audited(bytes(content)) == {"differs": 1}
    cut = audited(whole[0][1][:middle])
    left = len(list(warc_audit.read_records(whole[0][1][:middle])))
    assert cut.pop("differs", 0) <= 1 and cut == {"missing": len(own) - left}


def brute_root(hashes, ranges, fanout):
    nodes = list(zip(hashes, ranges, strict=True))
    first = True
    while len(nodes) > 1 or first:
        first, above = False, []
        for at in range(0, len(nodes), fanout):
            own = nodes[at : at + fanout]
            begin, end = own[0][1][0], own[-1][1][1]
            above.append((hashlib.sha256(f"{begin}:{end}:{''.join(h for h, _ in own)}".encode()).hexdigest(), (begin, end)))
        nodes = above
    return nodes[0][0]


@pytest.mark.parametrize("count", [1, 4, 5, 65])
def test_roots(frame, count):
    rows = [("f", n, 10 * n, 10, hashlib.sha256(str(n).encode()).hexdigest()) for n in range(count)]
    tree = warc_audit.merkle_tree(frame(rows, "file string, ordinal long, offset long, length long, sha256 string"), 4)
    root = tree.orderBy(F.desc("level")).first()
    assert root["hash"] == brute_root([r[4] for r in rows], [(r[2], r[2] + 10) for r in rows], 4)


def test_only_branches_that_differ_are_compared(spark, frame):
    rows = [("f", n, n, 1, str(n)) for n in range(64)] + [("g", n, n, 1, str(n)) for n in range(64)]
    schema = "file string, ordinal long, offset long, length long, sha256 string"
    other = [(*r[:4], "bad") if r[:2] == ("g", 37) else r for r in rows]
    one, two = (stored(warc_audit.merkle_tree(frame(x, schema), 4), "tree") for x in (rows, other))
    found = warc_audit.mismatches(one, two, 4).collect()
    assert [(r["file"], r["ordinal"], r["status"]) for r in found] == [("g", 37, "differs")]


def test_a_lost_file_is_found_by_trees_of_different_depth(spark, frame):
    schema = "file string, ordinal long, offset long, length long, sha256 string"
    rows = [(file, n, n, 1, str(n)) for file, count in (("f", 16), ("g", 3), ("h", 5)) for n in range(count)]
    other = [r for r in rows if r[0] != "g"] + [("f", 16, 16, 1, "16")]
    one, two = (stored(warc_audit.merkle_tree(frame(x, schema), 4), "tree") for x in (rows, other))
    lost = [("f", 16), ("g", 0), ("g", 1), ("g", 2)]
    for a, b, names in ((one, two, ("added", "missing")), (two, one, ("missing", "added"))):
        found = sorted((r["file"], r["ordinal"], r["status"]) for r in warc_audit.mismatches(a, b, 4).collect())
        assert found == [(*x, names[x[0] == "g"]) for x in lost]
    assert warc_audit.mismatches(one, one.limit(0), 4).count() == len(rows)


def test_plain_and_broken_files():
    record = b"WARC/1.0\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    plain = list(warc_audit.read_records(record * 2))
    assert plain == list(warc_audit.read_records(gzip.compress(record) + gzip.compress(record))) and [r[0] for r in plain] == [0, len(record)]
    broken = list(warc_audit.read_records(record + b"rubbish"))
    assert broken[1] == (len(record), b"rubbish", {}, b"") and list(warc_audit.read_records(b"")) == []
    assert len(list(warc_audit.read_records(gzip.compress(record * 500)[:-9] + b"xx"))) >= 1


def test_no_pages(spark, frame):
    one = replica(spark, frame, [])
    assert warc_audit.audit(spark, one, one).collect() == []
