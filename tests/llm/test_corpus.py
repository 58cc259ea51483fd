"""Language, urls, mixing, archives, personal data and decontamination, with odd rows."""

import base64
import collections
import hashlib
import random
import re
import time

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from basketlens.llm import pii, warc
from basketlens.llm.decontaminate import contaminated_passages, remove_contaminated, smith_waterman
from basketlens.llm.lang_id import detect_languages, held_out, learn_languages, trigrams
from basketlens.llm.mixing import mix_sources, sainte_lague, source_targets
from basketlens.llm.pii import personal_data
from basketlens.llm.url_filter import HOST_RULES, RULES, host_rule, judge_urls, pattern_rule
from basketlens.staging import new_path

DOC = "doc_id long, text string"


def plain(rows):
    return sorted(rows, key=str)


# --- urls -----------------------------------------------------------------------------


def judged(url):
    rest = url.partition("://")[2] if url and "://" in url else ""
    host = brute.lower(re.match("[^/?#]*", rest).group())
    path = re.match("[^?#]*", rest[len(host) :]).group()
    fit = []
    for r in HOST_RULES:
        rule_host, slash, rule_path = r.name.partition("/")
        if (host == rule_host or host.endswith("." + rule_host)) and path.startswith(slash + rule_path):
            fit.append((len(r.name), r.name, r.verdict))
    if fit:
        return host, path, max(fit)[1], max(fit)[2]
    patterns = [r for r in RULES if r.rank == 0 and re.search(r.regex.replace(r"\z", r"\Z"), host + path)]
    verdict = "block" if any(r.verdict == "block" for r in patterns) else "allow"
    return host, path, None, verdict


def test_urls_match_brute_force(spark):
    rng = random.Random(1)
    hosts = ["example.org", "EXAMPLE.org", "a.b.example.org", "notexample.org", "org", "x.com", "ads.shop.net", "m.doubleclick.net", "", "ünï.org", "h.net:80"]
    paths = ["", "/", "/es/", "/es/a?b=/en/1", "/en/1", "/en/123", "/en/2", "/fr/x", "/de/x#y", "/a/cart/b", "/p.jpg", "/p.jpgx", "/x\ny/feed/", "/Login/", "/login/x", "?q=://z", "#f"]
    urls = [rng.choice(["http://", "https://", "", "//", "ftp://"]) + rng.choice(hosts) + rng.choice(paths) for _ in range(900)]
    rows = [(i % 700, u) for i, u in enumerate(urls)] + [(1, None), (None, None), (None, "http://a.org/"), (5, ""), (5, ""), (6, "://"), (7, "http://" + "a/" * 20000)]
    frame = spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit(1)).repartition(5)
    got = judge_urls(frame)
    assert got.columns == ["id", "host", "path", "rule", "verdict"]
    assert plain(tuple(r) for r in got.collect()) == plain((i, *judged(u)) for i, u in rows)


def test_url_rules_by_hand(spark):
    assert host_rule("example.org/en/1", "block").tokens == ("example", "org", "en")
    assert pattern_rule("*/ads/*x", "block").tokens == ("ads",)
    rules = [pattern_rule("a*", "block"), host_rule("b", "allow")]
    frame = spark.createDataFrame([(1, "x://ab"), (2, "x://c.B/"), (3, "x://bb"), (4, "x://b")], "page_id long, url string")
    assert {(r["id"], r["rule"], r["verdict"]) for r in judge_urls(frame, rules).collect()} == {
        (1, None, "block"), (2, "b", "allow"), (3, None, "allow"), (4, "b", "allow"),
    }
    assert {r["verdict"] for r in judge_urls(frame, [], otherwise="block").collect()} == {"block"}
    assert judge_urls(frame.limit(0)).count() == 0


def test_host_rules_do_not_fit_hosts_inside_paths(spark):
    urls = [
        "https://shop.com/a.org/b", "https://cdn.net/x/www.example.org/es/1", "https://web.archive.net/http:/example.org/en/1",
        "https://x.org/y.com/de/z", "https://shop.com/.org/", "https://a.example.org/es/www.x.com/de/",
        "https://m.net/a.com/fr/p.jpg", "https://www.com/de/.org/", "https://n.net/a.b",
    ]
    frame = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = judge_urls(frame).collect()
    assert plain(tuple(r) for r in got) == plain((i, *judged(u)) for i, u in enumerate(urls))
    bare = judge_urls(frame, [host_rule("a.b", "block"), host_rule("n.net", "block")]).collect()
    assert {r["id"]: r["rule"] for r in bare if r["rule"]} == {8: "n.net"}


def test_url_plan_has_no_python_and_one_wide_shuffle(spark):
    plan = judge_urls(spark.createDataFrame([(1, "x://ab")], "page_id long, url string"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan.split("Physical Plan")[-1])


# --- mixing ---------------------------------------------------------------------------


@pytest.mark.parametrize("seed", range(4))
def test_sainte_lague_matches_seat_by_seat(spark, seed):
    rng = random.Random(seed)
    votes = {f"s{k}": float(rng.choice([0, 1, 2, rng.randrange(1, 10_000)])) for k in range(rng.randrange(2, 25))}
    votes["s0"] = 5000.0
    seats = rng.choice([0, 1, 7, 100, 2500])
    frame = spark.createDataFrame([(k, v, seats) for k, v in votes.items()], "name string, votes double, blocks long")
    got = {r["name"]: r["quota"] for r in sainte_lague(frame, ["name"]).collect()}
    assert got == {k: n for k, n in brute.sainte_lague(votes, seats).items() if votes[k] > 0}


def test_targets_share_the_excess(spark):
    frame = spark.createDataFrame([("a", 10), ("b", 1000), (None, 90), ("c", 0)], "source string, source_size long")
    got = {r["source"]: r["target"] for r in source_targets(frame, (5, 2, 1), 150, 2).collect()}
    # a and the missing source stop at twice their size, b takes the rest.
    assert got == {"a": 20.0, "b": 1650.0 - 20 - 180, "c": 0.0, None: 180.0} and sum(got.values()) == 1650


@pytest.mark.parametrize("shard_words", [64, 1 << 22])
def test_mix_is_near_its_targets(spark, shard_words):
    rng = random.Random(2)
    sources = ["big"] * 6 + ["mid", "mid", "tiny", None]
    rows = [(i % 480, " ".join("w" for _ in range(rng.randrange(0, 90))), rng.choice(sources)) for i in range(500)]
    rows += [(900, None, "big"), (901, "", "big"), (902, "a\x0bb\xa0c", "one"), (None, "x y", "big"), (903, "w " * 50_000, "long")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit("clash"))
    got = mix_sources(frame.repartition(6), block_words=8, shard_words=shard_words).collect()
    again = mix_sources(frame.repartition(2), block_words=8, shard_words=shard_words).collect()
    assert plain(tuple(r) for r in got) == plain(tuple(r) for r in again)
    assert plain((r["id"], r["source"], r["size"]) for r in got) == plain((i, s, len(brute.words(t))) for i, t, s in rows)
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in got)
    taken, target, shards = collections.Counter(), {}, collections.Counter()
    for r in got:
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        shards[r["source"]] += r["size"]
    for s in target:
        assert abs(taken[s] - target[s]) <= 8 * (2 + shards[s] / shard_words * 2), s


def test_mix_of_nothing(spark):
    schema = "doc_id long, text string, source string"
    assert mix_sources(spark.createDataFrame([], schema)).count() == 0
    assert [r["taken"] for r in mix_sources(spark.createDataFrame([(1, None, "a"), (2, " ", None)], schema)).collect()] == [0, 0]


# --- languages ------------------------------------------------------------------------


def test_trigrams_by_hand():
    grams, owner = trigrams(["Ab, c1", "", "--", "É"])
    show = ["".join(chr(int(g) >> s & 0x1FFFFF) for s in (42, 21, 0)) for g in grams]
    assert list(zip(show, owner.tolist(), strict=True)) == [(" ab", 0), ("ab ", 0), ("b c", 0), (" c ", 0), (" é ", 3)]


def test_languages_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    learned = learn_languages(docs.where(~held_out(F.col("doc_id"))))
    out = held_out(F.col("other.doc_id"))
    found = detect_languages(docs, learned).where(out)
    right = found.agg(F.avg((F.col("lang_pred") == F.col("other.lang")).cast("double"))).first()[0]
    assert right > 0.99
    assert found.where("score < 0 or score > 1").count() == 0


def test_language_lookups_return_all_languages(spark):
    rows = [("aaa", "x"), ("aaa bbb", "y"), (None, "x"), ("ccc", None), ("...", "z")]
    learned = learn_languages(spark.createDataFrame(rows, "text string, lang string"))
    assert learned.languages == ["x", "y"]
    bits = dict(zip(["aaa", "bbb"], [learned.lookup(trigrams([t])[0]) for t in ("aaa", "bbb")], strict=True))
    assert all(int(m[0]) & 3 == 3 for m in bits["aaa"]) and all(int(m[0]) & 3 == 2 for m in bits["bbb"])
    odd = [(1, None, 1), (2, "", 1), (3, "12 !", 1), (4, "BBB", 1), (5, "qqq", 1), (4, "BBB", 1), (6, "bbb " * 40_000, 1)]
    got = detect_languages(spark.createDataFrame(odd, "doc_id long, text string, lang_pred long"), learned).collect()
    assert {(r["other"]["doc_id"], r["lang_pred"]) for r in got} == {(1, "und"), (2, "und"), (3, "und"), (4, "y"), (5, "y"), (6, "y")}
    assert len(got) == len(odd) and {r["score"] for r in got if r["lang_pred"] == "und"} == {0.0}


def test_filter_grows_with_the_trigrams(spark):
    rng = random.Random(16)
    text = lambda low: "".join(chr(rng.randrange(low, low + 2000)) for _ in range(3000))
    rows = [(text(0x4E00), "zh"), (text(0xAC00), "ko"), ("plain words of a third language", "en")]
    frame = spark.createDataFrame(rows, "text string, lang string")
    learned = learn_languages(frame, bits=10)
    assert 0 < learned.false_positive.max() < 0.011 and learned.masks.dtype == np.uint8
    assert detect_languages(frame, learned).where("lang_pred <> other.lang").count() == 0


def test_languages_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert learn_languages(empty) is None
    assert detect_languages(empty, None).count() == 0
    assert [r["lang_pred"] for r in detect_languages(spark.createDataFrame([(1, "abc")], DOC), None).collect()] == ["und"]


def test_more_than_sixty_four_languages(spark):
    rng = random.Random(3)
    vocabulary = {f"l{k:02d}": ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(40)] for k in range(80)}
    rows = [(" ".join(rng.choices(w, k=120)), lang) for lang, w in vocabulary.items() for _ in range(3)]
    frame = spark.createDataFrame(rows, "text string, lang string")
    found = detect_languages(frame, learn_languages(frame))
    assert found.where("lang_pred <> other.lang").count() == 0


# --- archives -------------------------------------------------------------------------


def page_rows(rng):
    fake = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:999>\r\nContent-Length: %d\r\n\r\nHTTP/1.1 200 OK\r\n\r\nxx"
    rows = []
    for i in range(120):
        html = rng.choice(
            [None, "", f"line {i}\r\n" * rng.randrange(1, 60) + "\r\n\r\n", fake % rng.choice([0, 5, 40, 3000, 10**9]), "x" * rng.randrange(3000), fake % 100 + "\n" + fake % 20000, "é" * 50]
        )
        rows.append((i if i % 30 else None, f"http://a/{i}\r\nX: y", html))
    return rows + [(7, "http://again/", ""), (7, "http://again/", "")]


def want_records(rows, least=0):
    groups = collections.defaultdict(list)
    for i, _, h in rows:
        groups[h or ""].append(i)
    want = collections.Counter()
    for i, _, h in rows:
        data = (h or "").encode()
        ids = [x for x in groups[h or ""] if x is not None]
        revisit = len(data) >= least and len(groups[h or ""]) > 1 and bool(ids) and i != min(ids)
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        want[(i, "revisit" if revisit else "response", len(data), digest, min(ids) if revisit else None)] += 1
    return want


@pytest.mark.parametrize("split", ["64m", "900"])
def test_archives_round_trip(spark, split):
    rows = page_rows(random.Random(4))
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    path = new_path(spark, "test-warc")
    warc.write_archives(frame, path, least_bytes=0)
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum", "spark.sql.shuffle.partitions")
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        if split != "64m":
            for k, v in zip(keys, (split, "1", "60", "4"), strict=True):
                spark.conf.set(k, v)
        got = warc.read_archives(spark, path, payloads=True).collect()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    number = lambda uri: int(uri[10:-1]) if uri and uri != "<urn:page:>" else None
    found = collections.Counter(
        (number(r["record_id"]), r["type"], r["payload_bytes"], r["payload_digest"] or r["stated_digest"], number(r["refers_to_id"])) for r in got
    )
    assert found == want_records(rows)
    assert all(r["stated_digest"] == r["payload_digest"] for r in got if r["type"] == "response")
    assert collections.Counter(r["payload"] for r in got if r["payload"] is not None)[("é" * 50).encode()] == 1


def test_small_payloads_are_not_revisited(spark):
    rows = [(2, "u", "ab"), (1, "u", "ab"), (4, "u", "abc"), (3, "u", "abc")]
    path = new_path(spark, "test-warc")
    warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string"), path, least_bytes=3)
    got = {(r["record_id"], r["type"]) for r in warc.read_archives(spark, path).collect()}
    assert got == {("<urn:page:1>", "response"), ("<urn:page:2>", "response"), ("<urn:page:3>", "response"), ("<urn:page:4>", "revisit")}


def test_archives_of_nothing(spark):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.archive_round_trip(empty).count() == 0


def test_pointer_jumping_follows_long_chains(spark):
    rng = random.Random(5)
    offsets = sorted(rng.sample(range(1, 10**6), 900))
    chain = [0, *offsets[::3]]
    nodes = [(f, a, b) for f in (1, 2) for a, b in zip(chain, [*chain[1:], 10**7], strict=True)]
    stray = [(1, a, rng.choice(offsets)) for a in offsets if a not in chain]
    got = warc.reachable(spark.createDataFrame(nodes + stray, "file long, start long, out long"))
    assert {tuple(r) for r in got.collect()} == {(f, a) for f in (1, 2) for a in chain}


# --- personal data --------------------------------------------------------------------


def test_base_spans_match_brute_force(spark):
    rng = random.Random(6)
    bits = ["a", "b@", "c.d", ".", " ", "1", "23", "+", "-", "@x.y", "4 5", "\n", "é", "😀", "(", ")", "255", ".1.2.3", "4111111111111111", "+1 (017) 555-7713", "_z@q.w-e.r"]
    rows = [(i, "".join(rng.choice(bits) for _ in range(rng.randrange(0, 80)))) for i in range(1500)]
    rows += [(1, None), (2, ""), (None, "a@b.co"), (None, "a@b.co"), (3, rows[3][1]), (4, "9" * 60_000 + " a" * 30_000 + "@x.y"), (5, "1.2.3.4 " * 5000)]
    frame = spark.createDataFrame(rows, DOC).withColumn("id", F.lit(0)).withColumn("spans", F.lit("clash")).repartition(5)
    got = personal_data(frame)
    want = []
    for i, t in rows:
        spans = brute.base_spans(t)
        counts = collections.Counter(s.split(":")[0] for s in spans.split(",") if s)
        want.append((i, *(counts[k] for k in pii.KINDS), spans))
    assert plain(tuple(r)[:6] for r in got.collect()) == plain(want)


def test_contexts_find_unseen_identifiers(spark):
    rng = random.Random(7)
    rows = []
    for i in range(40):
        rows.append((i, f"please contact me at user{i}@mail.example.com for the {rng.randrange(10)} things"))
    rows += [(100, "please contact me at user-77(at)mail, thanks"), (101, "see page 123456 of the book"), (102, 'Contact ME AT "user_99[at]x"!')]
    rows += [(200 + i, f"see page {rng.randrange(10**6)} of the book") for i in range(30)] + [(300, "see page a@b.co now")]
    got = {r["id"]: r for r in personal_data(spark.createDataFrame(rows, DOC)).collect()}
    text = dict(rows)
    start = text[100].index("user-77")
    assert got[100]["spans"] == f"context_email:{start}:{start + len('user-77(at)mail')}" and got[100]["base"] == ""
    start = text[102].index("user_99")
    assert got[102]["spans"] == f"context_email:{start}:{start + len('user_99[at]x')}"
    assert all(got[i]["spans"] == got[i]["base"] for i in got if i not in (100, 102))
    assert got[100]["n_email"] == 0


def plain_contexts(rows, rounds=3, least=3, confidence=0.6):
    """context spans of every (id, text) by scoring patterns and instances in plain loops."""
    opening, closing = "\"'([<{", "\"')]>},.;:!?#$%&*"
    tokens = []
    for i, t in rows:
        words = [(m.group(), m.start()) for m in re.finditer(r"[^\x20\x09-\x0D]+", t or "")]
        base = [s.split(":") for s in brute.base_spans(t).split(",") if s]
        is_token = [re.search("[0-9@]", w) is not None for w, _ in words]
        for k, (w, at) in enumerate(words):
            if not is_token[k]:
                continue
            instance = w.lstrip(opening)
            start = at + len(w) - len(instance)
            instance = instance.rstrip(closing)
            end = start + len(instance)
            first = words[k - 1][0].lower() if k and not is_token[k - 1] else ""
            edge = "#" if any(is_token[:k]) else "^"
            second = words[k - 2][0].lower() if first and k > 1 and not is_token[k - 2] else edge
            after = words[k + 1][0].lower() if k + 1 < len(words) and not is_token[k + 1] else ""
            touching = [b for b in base if int(b[1]) < end and int(b[2]) > start]
            kind = sorted(touching, key=lambda b: (-int(b[2]), pii.KINDS.index(b[0])))[0][0] if touching else None
            hexes = re.fullmatch("[0-9A-Fa-f]{32,}", instance) and re.search("[0-9]", instance) and re.search("[A-Fa-f]", instance)
            if not kind and hexes and first[-1:] in ("=", ":") and first:
                kind = "secret"
            patterns = [f"{second} {first} _", f"{first} _"] if first else []
            patterns += [f"_ {after}"] if after else []
            patterns += [f"{first} _ {after}"] if first and after else []
            if instance:
                tokens.append((i, start, end, instance, kind, bool(touching), patterns))
    edges = {}
    for _, _, _, instance, kind, _, patterns in tokens:
        for p in patterns:
            edges[p, instance] = max(edges.get((p, instance)) or "", kind or "") or None
    score = collections.defaultdict(float)
    seed = collections.defaultdict(float)
    for (_, x), kind in edges.items():
        seed[x] = max(seed[x], float(kind is not None))
    score.update(seed)
    for _ in range(rounds):
        trusted = {}
        for p in {p for p, _ in edges}:
            own = [x for q, x in edges if q == p]
            kinds = collections.Counter(edges[p, x] for x in own if edges[p, x])
            mean = round(sum(score[x] for x in own) / len(own), 9)
            if sum(kinds.values()) >= least and mean >= confidence:
                trusted[p] = (mean, min(k for k in kinds if kinds[k] == max(kinds.values())))
        said = collections.defaultdict(lambda: 1.0)
        for p, x in edges:
            if p in trusted:
                said[x] *= max(1 - trusted[p][0], 1e-6)
        score = collections.defaultdict(float, {x: max(seed[x], 1 - said[x] if x in said else 0) for x in seed})
    out = collections.defaultdict(set)
    for i, start, end, _, _, covered, patterns in tokens:
        best = [trusted[p] for p in patterns if p in trusted]
        if best and not covered:
            out[i].add(f"context_{max(best)[1]}:{start}:{end}")
    return out


def test_contexts_match_plain_scoring(spark):
    """Patterns of all sorts, with ties of kinds, odd tokens, and seeds of every kind."""
    rng = random.Random(17)
    seeds = [lambda: f"u{rng.randrange(500)}@h.example.com", lambda: f"10.{rng.randrange(200)}.1.{rng.randrange(200)}", lambda: "+1 (017) 555-%04d" % rng.randrange(10**4)]
    hexes = lambda: f'"{rng.randrange(16**40):040x}"'
    rows = []
    for i in range(400):
        t = []
        for _ in range(rng.randrange(1, 5)):
            t += [rng.choice(["mail", "call", "Host", "x", "ab"]), rng.choice(["me", "at", "token =", "to:", ""])]
            t += [rng.choice([rng.choice(seeds), rng.choice(seeds), hexes, lambda: f"n{rng.randrange(50)}", lambda: "@"])(), rng.choice(["now", "or", "", "please."])]
        rows.append((i, " ".join(t)))
    want = plain_contexts(rows)
    got = personal_data(spark.createDataFrame(rows, DOC).repartition(4)).collect()
    assert {r["id"]: {s for s in r["spans"].split(",") if s.startswith("context")} for r in got} == {i: want.get(i, set()) for i, _ in rows}
    assert sum(map(len, want.values())) > 50 and len({s.split(":")[0] for x in want.values() for s in x}) >= 4


def test_planted_contexts_are_found(spark):
    """Identifiers of unknown form behind one word, before one word and between two; values of a token; clean rows stay clean."""
    rng = random.Random(18)
    rows = []
    for i in range(300):
        known, unseen = f"user{i}@mail.example.com", f"user{i}_at_mail{rng.randrange(100)}"
        own = known if i % 3 else unseen
        rows.append((i, rng.choice([f"some text, mailto {own} some words", f"we wrote {own} yesterday", f"reach {own} anytime"])))
    rows += [(1000 + i, f'x api token = "{rng.randrange(16**40):040x}" and more') for i in range(50)] + [(1100, "the api token = s3cr3t-key in use")]
    rows += [(2000 + i, f"page {rng.randrange(900)} of chapter {rng.randrange(40)} in volume {i % 7}") for i in range(200)]
    got = {r["id"]: r["spans"] for r in personal_data(spark.createDataFrame(rows, DOC)).collect()}
    planted = [i for i in range(0, 300, 3)]
    assert sum("context_email" in got[i] for i in planted) >= 0.9 * len(planted)
    assert all("context_secret" in got[1000 + i] for i in range(50)) and "context_secret" in got[1100]
    assert all(got[i] == "" for i in range(2000, 2200))


def test_many_matches_in_one_text(spark):
    """Time grows with the text: 100 000 matches of two kinds and as many tokens."""
    text = "a@b.co 1.2.3.4 " * 100_000
    begun = time.time()
    (row,) = personal_data(spark.createDataFrame([(1, text)], DOC)).select("n_email", "n_ip", F.length("base").alias("n")).collect()
    assert (row["n_email"], row["n_ip"]) == (100_000, 100_000) and row["n"] > 2_000_000
    assert time.time() - begun < 60


def test_personal_data_of_nothing_and_its_plan(spark):
    got = personal_data(spark.createDataFrame([], DOC))
    assert got.count() == 0 and not re.search("Python|Pandas|ArrowEval", got._jdf.queryExecution().toString())


# --- decontamination ------------------------------------------------------------------


def aligned(passage, item):
    best = 0
    rows = [[0] * (len(passage) + 1) for _ in range(len(item) + 1)]
    for i, a in enumerate(item, 1):
        for j, b in enumerate(passage, 1):
            rows[i][j] = max(0, rows[i - 1][j - 1] + (1 if a == b else -1), rows[i - 1][j] - 1, rows[i][j - 1] - 1)
            best = max(best, rows[i][j])
    return best


def test_alignment_matches_the_textbook():
    rng = np.random.default_rng(8)
    for _ in range(60):
        a, b = (rng.integers(0, 4, rng.integers(0, 30)).astype(np.uint64) for _ in range(2))
        assert smith_waterman(a, b)[0] == aligned(a.tolist(), b.tolist())


def test_leaks_are_found_and_clean_texts_are_left(spark):
    rng = random.Random(9)
    w = lambda: str(rng.randrange(10**5))
    common = ["the", "of", "and", "to", "in"]
    items = [(k, " ".join(rng.choice(common) if rng.random() < 0.4 else w() for _ in range(rng.randrange(12, 60)))) for k in range(40)]
    rows, leaks = [], set()
    for i in range(400):
        own = [rng.choice(common) if rng.random() < 0.5 else w() for _ in range(rng.randrange(0, 200))]
        if i % 4 == 0:
            item, text = rng.choice(items)
            copy = text.upper().split()
            for _ in range(len(copy) // 10):  # replaced, left out and put in
                at = rng.randrange(len(copy))
                copy[at : at + rng.randrange(2)] = [w()] * rng.randrange(2)
            own[len(own) // 2 : len(own) // 2] = [x + "," for x in copy]
            leaks.add((i, item))
        rows.append((i, " ".join(own)))
    odd = [(500, None), (501, ""), (None, items[0][1]), (502, items[1][1] + " pad " * 30_000), (502, "x")]
    frame = spark.createDataFrame(rows + odd, DOC).withColumn("id", F.lit(1)).withColumn("start", F.lit(2))
    bench = spark.createDataFrame([*items, (90, None), (91, ""), (92, "the of"), (93, "the of and")], "item_id long, text string")
    found = contaminated_passages(frame, bench).collect()
    got = {(r["id"], r["item_id"]) for r in found}
    assert leaks | {(None, 0), (502, 1)} <= got
    assert {i for i, k in got if k != 93} == {i for i, _ in leaks} | {None, 502}
    # An item of three words is matched by those three words only.
    plain_words = [(i, re.sub("[^0-9a-z ]", "", brute.lower(t))) for i, t in rows]
    assert {i for i, k in got if k == 93} >= {i for i, t in plain_words if "the of and" in t and i % 4}
    clean = remove_contaminated(frame, bench.where("item_id < 90"))
    assert clean.columns == frame.columns
    assert {r["doc_id"] for r in clean.collect()} == {i for i, _ in rows + odd} - {i for i, _ in leaks} - {None, 502}


def test_every_alignment_at_the_threshold_is_found(spark):
    rng = random.Random(14)
    w = lambda: str(rng.randrange(10**6))
    items = [(k, [w() for _ in range(n)]) for k, n in enumerate([8, 12, 16, 16, 24, 24, 40, 40, 70, 100])]
    rows = []
    for k, words in items:
        n = len(words)
        for edits in range(n // 5, n // 2):
            replaced = list(words)
            for at in rng.sample(range(n), edits // 2):
                replaced[at] = w()
            padded = [x for i, x in enumerate(words) for x in ([x, w()] if i % 2 and i < 2 * edits else [x])]
            split = [*words[: n // 2], *[w() for _ in range(edits)], *words[n // 2 :]]
            sixth = [w() if i % 6 == edits % 6 else x for i, x in enumerate(words)]
            for copy in (replaced, padded, split, sixth):
                rows.append([*[w() for _ in range(rng.randrange(40))], *copy, *[w() for _ in range(rng.randrange(40))]])
    rows += [words for _, words in items]
    want = {
        (i, k) for i, row in enumerate(rows) for k, words in items
        if set(row) & set(words) and smith_waterman(np.array(row, "u8"), np.array(words, "u8"))[0] >= max(-(-len(words) // 2), min(len(words), 8))
    }
    frame = spark.createDataFrame([(i, " ".join(row)) for i, row in enumerate(rows)], DOC)
    bench = spark.createDataFrame([(k, " ".join(words)) for k, words in items], "item_id long, text string")
    got = contaminated_passages(frame, bench).collect()
    assert {(r["id"], r["item_id"]) for r in got} == want and len(got) == len(want) > 300


def test_decontamination_of_nothing(spark):
    docs, bench = spark.createDataFrame([(1, "a b c d")], DOC), spark.createDataFrame([], "item_id long, text string")
    assert contaminated_passages(docs, bench).count() == 0
    assert contaminated_passages(docs.limit(0), spark.createDataFrame([(1, "a b c")], "item_id long, text string")).count() == 0
    assert remove_contaminated(docs, bench).count() == 1
