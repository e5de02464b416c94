import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F, types as T

import pagewright.queries as core
from pagewright import job
from pagewright.functions.settings import Settings, from_env
from pagewright.functions.text import heading_text, heading_text_py
from pagewright.operators import sync, target
from pagewright.plans.repeats import longest_repeat, longest_run, unresolved, without_repeated_renderings
from pagewright.plans.records import HASHED, records
from pagewright.sources.html import parse_page
from pagewright.sources.http import PoliteClient
from pagewright.sources.remote import RemoteClient, as_documents
from pagewright.sources.listing import discover, listing_links, require_access


def brute_repeat(blocks, least, chars):
    for size in range(len(blocks) // 2, least - 1, -1):
        for second in range(size, len(blocks) - size + 1):
            for first in range(second - size + 1):
                if blocks[first : first + size] == blocks[second : second + size] and sum(len(t) for _, t in blocks[first : first + size]) >= chars:
                    return first, second, size
    return None


def test_longest_repeat_equals_brute_force():
    rng = random.Random(3)
    for _ in range(400):
        blocks = [("paragraph", rng.choice("abc")) for _ in range(rng.randint(0, 14))]
        assert longest_repeat(blocks, 2, 2) == brute_repeat(blocks, 2, 2)
    for _ in range(400):
        blocks = [("paragraph", rng.choice(["a", "bb", ""])) for _ in range(rng.randint(0, 14))]
        least, chars = rng.choice([(1, 3), (2, 2), (1, 0), (3, 4)])
        texts = np.array([["a", "bb", ""].index(t) for _, t in blocks], np.int64)
        assert longest_run(texts, np.array([len(t) for _, t in blocks], np.int64), least, chars) == brute_repeat(blocks, least, chars)


def test_two_renderings_become_one():
    one = [("heading_2", "주요 업무"), *[("bulleted_list_item", f"{'가' * 40}{i}") for i in range(8)]]
    assert without_repeated_renderings(one + one) == one
    assert without_repeated_renderings(one[:7] + one) == one  # the complete copy stays
    assert without_repeated_renderings([("paragraph", "a"), ("paragraph", "a"), ("heading_3", "x"), ("heading_3", "x")]) == [("paragraph", "a"), ("heading_3", "x")]
    plain = one[1:]
    assert without_repeated_renderings(plain + plain) == plain  # no heading in either
    part = [("paragraph", "나" * 40 + str(i)) for i in range(4)]
    assert unresolved(part + [("paragraph", "-")] + part) and not unresolved(part)


def test_page_shapes():
    p = parse_page("<h1>T</h1><main><p>a<br>b</p><p>a</p><hr><ol><li>one<ul><li>two</li></ul></li></ol><table><tr><th>x</th><td>y</td></tr></table><h3>관련 공고</h3><p>gone</p></main>", "https://s.example/archives/1")
    assert [(b["kind"], b["text"]) for b in p["blocks"]] == [
        ("paragraph", "a"), ("paragraph", "b"), ("paragraph", "a"), ("divider", ""), ("numbered_list_item", "one"), ("bulleted_list_item", "two"), ("paragraph", "x | y"),
    ]
    assert parse_page(None, None)["blocks"] == [] and parse_page("", "")["title"] == "제목 미기재"
    p = parse_page("<p>a</p><a href='https://x]'>지원하기</a><a href='https://forms.example/1'>form</a><a href='https://y.example/2'>지원하기</a>", "https://s.example/")
    assert p["apply_url"] == "https://y.example/2"


def test_heading_text_twins(spark):
    texts = ["💼 주요 업무 ✨", "  [가] ", "a’b", "", "—", " 나 "]
    got = [r[0] for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(heading_text(F.col("t"))).collect()]
    assert got == [heading_text_py(t) for t in texts]


def client(answers, **how):
    seen, waits = [], []

    def get(url, timeout):
        seen.append(url)
        x = answers.pop(0)
        if isinstance(x, Exception):
            raise x
        return x

    now = [0.0]
    return PoliteClient("https://s.example/", get_once=get, sleep=lambda s: (waits.append(s), now.__setitem__(0, now[0] + s)), clock=lambda: now[0], **how), seen, waits


def test_polite_client():
    c, seen, waits = client([(200, "User-agent: *\nDisallow: /private"), (200, "page")])
    assert c.fetch("/private/x")[1] == "blocked" and c.fetch("/a") == ("https://s.example/a", "ok", "page")
    assert waits == [2.5] and seen == ["https://s.example/robots.txt", "https://s.example/a"]
    c, _, waits = client([(404, ""), OSError(), (500, ""), (200, "x")], delay=0)
    assert c.fetch("/a")[1] == "ok" and waits == [2, 6]
    for code, status in ((404, "not_found"), (403, "blocked"), (429, "rate_limited"), (410, "error")):
        c, seen, _ = client([(404, ""), (code, "")], delay=0)
        assert c.fetch("/a")[1] == status and len(seen) == 2


def test_settings():
    s = from_env({"PAGEWRIGHT_DRY_RUN": " Yes ", "PAGEWRIGHT_MAX_POSTS": "", "PAGEWRIGHT_DELAY_SECONDS": "1.5", "PAGEWRIGHT_MODE": "full"})
    assert s.dry_run and s.max_posts == 0 and s.delay_seconds == 1.5 and s.page_budget() == 0
    assert Settings().page_budget() == 3 and Settings(list_pages=7).page_budget() == 7
    with pytest.raises(ValueError):
        from_env({"PAGEWRIGHT_MODE": "x"})


def test_discovery_stops(spark):
    page = lambda *ids: "".join(f"<li><a href='/archives/{i}?x'>t</a><a rel='category' href='/c'>주니어경력</a></li>" for i in ids)
    rows = [(1, page(3, 1, 3), "ok"), (2, page(1), "ok"), (3, page(2), "ok"), (4, page(2), "ok"), (5, page(1), "ok"), (6, page(9), "ok")]
    df = spark.createDataFrame([(n, f"https://s.example/d/page/{n}/", h, s) for n, h, s in rows], "page_no int, page_url string, html string, status string")
    got = discover(df, "s.example", 0).orderBy("page_no", "pos").collect()
    assert [r.url[-1] for r in got] == ["3", "1", "2"] and got[0].categories == ["주니어경력"]
    assert discover(df, "s.example", 2).count() == 2
    with pytest.raises(Exception, match="refused"):
        require_access(df.select(F.col("page_url").alias("url"), F.lit("rate_limited").alias("status"))).collect()


def test_queue_and_recheck(spark):
    found = spark.createDataFrame([("a", 1, 0), ("b", 1, 1)], "url string, page_no int, pos int")
    again = spark.createDataFrame([("b", 0), ("c", 1)], "url string, pos int")
    assert [r.url for r in sync.visit_queue(found, again, 2).collect()] == ["a", "b"]
    assert sync.visit_queue(found, again).count() == 3
    t = spark.createDataFrame([("1", "u", "모집 중", dt.date(2026, 1, 2)), ("2", None, "모집 중", dt.date(2026, 1, 1)), ("3", "u", "마감", None)], "post_id string, source_url string, status string, last_checked date")
    assert sync.recheck(t, 0).count() == 0 and [r.post_id for r in sync.recheck(t, 2).collect()] == ["1"]  # blank rows go after the limit


PAGE = "<article><h1>프로덕트 디자이너 채용</h1><h3>주요 업무</h3><p>{}</p></article>"


def test_sync_run(spark):
    listing = spark.createDataFrame([], "url string, categories array<string>")
    url = "https://s.example/archives/{}".format
    pages = lambda *rows: spark.createDataFrame([(url(i), s, h) for i, s, h in rows], "url string, status string, html string")
    empty = spark.createDataFrame([], target.SCHEMA)
    first = sync.run(pages((1, "ok", PAGE.format("가")), (2, "ok", PAGE.format("나")), (3, "not_found", "")), listing, empty, "2026-08-12")
    assert first["summary"].first().asDict() == {"created": 2, "updated": 0, "unchanged": 0, "skipped": 1, "errors": 0}
    rows = first["target"].collect()
    held = spark.createDataFrame(rows, target.SCHEMA)
    second = sync.run(pages((1, "ok", PAGE.format("가")), (2, "not_found", ""), (4, "error", "")), listing, held, "2026-08-20")
    assert second["summary"].first().asDict() == {"created": 0, "updated": 1, "unchanged": 1, "skipped": 0, "errors": 1}
    now = {r.post_id: r for r in second["target"].collect()}
    assert now["1"].last_checked == dt.date(2026, 8, 12) and now["2"].status == "확인 필요" and now["2"].collection_status == "검토 필요"
    third = sync.run(pages((1, "ok", PAGE.format("다"))), listing, held, "2026-08-20")
    assert third["summary"].first().updated == 1 and {r.post_id: r.changed for r in third["target"].collect()}["1"]


def test_post_id_is_required(spark):
    with pytest.raises(Exception, match="no post id"):
        records(spark.createDataFrame([("https://s.example/x", "<p>a</p>")], "url string, html string"), "2026-08-12").collect()


def test_target_schema(spark):
    df = spark.createDataFrame([("a",)], "title string")
    with pytest.raises(ValueError, match="missing"):
        target.validate(df.schema)
    once, added, found = target.migrate(df)
    assert added == list(target.SECTIONS) and found == []
    assert target.migrate(once)[1] == []
    with pytest.raises(ValueError, match="wrong type"):
        target.migrate(spark.createDataFrame([(1,)], "essay_questions int"))
    target.validate(target.SCHEMA)
    target.create(spark, "made_here")
    with pytest.raises(ValueError, match="exists"):
        target.create(spark, "made_here")
    assert isinstance(target.SCHEMA["deadline"].dataType, T.DateType)


def test_properties_and_children(spark):
    pages = spark.createDataFrame([("https://s.example/archives/1", PAGE.format("".join(f"{i:04d}" for i in range(1000)))), ("https://s.example/archives/2", "<article><h1>웹툰 공모전</h1><h3>지원 대상</h3><p>누구나</p></article>")], "url string, html string")
    found = records(pages, "2026-08-12")
    rows = {r.post_id: r for r in target.properties(found, "2026-08-12").collect()}
    assert rows["2"].target_audience == "누구나" and rows["2"].qualifications == "" and rows["1"].target_audience == ""
    kids = target.child_blocks(found).filter("post_id = '1'").orderBy("pos").collect()
    assert [len(r.texts[0]) if r.texts else 0 for r in kids] == [2, 5, 1900, 1900, 200, 0, 4 + len("https://s.example/archives/1")]
    changed = spark.createDataFrame([("1",)], "post_id string")
    assert target.replace_children(target.child_blocks(found), target.child_blocks(found), changed).count() == target.child_blocks(found).count()


def test_stream(spark, tmp_path):
    from pagewright.streaming.upsert import sync_stream

    spark.createDataFrame([("https://s.example/archives/1", "ok", PAGE.format("가"))], "url string, status string, html string").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("url string, status string, html string").parquet(str(tmp_path / "in"))
    out = str(tmp_path / "out")
    q = sync_stream(stream, lambda: spark.createDataFrame([], target.SCHEMA), lambda df: df.write.parquet(out), "2026-08-12", str(tmp_path / "cp"))
    q.awaitTermination(300)
    assert spark.read.parquet(out).count() == 1


def site(spark, pages):
    """Answers from a dict url -> (status, html), and what was asked."""
    asked = []

    def fetch(urls):
        asked.extend(urls)
        return spark.createDataFrame([(u, *pages.get(u, ("not_found", ""))) for u in urls], "url string, status string, html string")

    return fetch, asked


def test_job_from_settings_to_summaries(spark):
    post = "https://s.example/archives/{}".format
    links = lambda *ids: ("ok", "".join(f"<li><a href='/archives/{i}'>t</a></li>" for i in ids))
    long = "프로덕트 디자이너 채용 " + "가" * 3000
    pages = {"https://s.example/d": links(1, 2), "https://s.example/d/page/2/": links(1), "https://s.example/d/page/3/": links(2), post(1): ("ok", PAGE.format("가")), post(2): ("ok", f"<article><h1>{long}</h1><h3>주요 업무</h3><p>{''.join(f'{i:04d}' for i in range(1000))}</p></article>")}
    fetch, asked = site(spark, pages)
    settings = Settings(site_url="https://s.example/", listing_url="https://s.example/d", target_table="job_target", mode="full")
    with pytest.raises(Exception, match="job_target"):
        job.run(spark, settings, fetch, dt.date(2026, 8, 12), print)
    spark.createDataFrame([], T.StructType([f for f in target.SCHEMA if f.name not in target.SECTIONS])).write.saveAsTable("job_target")
    with pytest.raises(ValueError, match="migrate"):
        job.run(spark, settings, fetch, dt.date(2026, 8, 12), print)
    assert target.migrate_table(spark, "job_target")[0] == list(target.SECTIONS) and target.migrate_table(spark, "job_target")[0] == []
    dry = []
    assert job.run(spark, Settings(**{**vars(settings), "dry_run": True, "max_posts": 1}), fetch, dt.date(2026, 8, 12), dry.append) == 0
    assert dry[-1] == 'SYNC_SUMMARY={"created": 0, "updated": 0, "unchanged": 0, "skipped": 1, "errors": 0}' and '"post_id":"1"' in dry[-3] and spark.table("job_target").count() == 0
    said = []
    assert job.run(spark, settings, fetch, dt.date(2026, 8, 12), said.append) == 0
    assert said[-2:] == ['FILTER_SUMMARY={"in_scope": 2, "filtered_non_design": 0, "filtered_ambiguous": 0}', 'SYNC_SUMMARY={"created": 2, "updated": 0, "unchanged": 0, "skipped": 0, "errors": 0}']
    rows = {r.post_id: r for r in spark.table("job_target").collect()}
    assert len(rows["2"].title) == 1900 and rows["1"].target_audience == "" and rows["1"].last_checked == dt.date(2026, 8, 12)
    back = {r.post_id: [b.text for b in r.blocks] for r in target.blocks_of(spark.table("job_target_children")).collect()}
    assert back["1"][0] == "원문" and back["1"][-1] == "출처: " + post(1) and [len(t) for t in back["2"][2:5]] == [1900, 1900, 200]
    assert target.outside_domains(spark.table("job_target")).count() == 0
    pages[post(1)], pages["https://s.example/d"] = ("ok", PAGE.format("다")), links(1)  # 2 is on no listing any more
    pages["https://s.example/d/page/3/"] = links(1)
    said.clear()
    asked.clear()
    assert job.run(spark, Settings(**{**vars(settings), "mode": "recent"}), fetch, dt.date(2026, 8, 20), said.append) == 0
    assert asked[-2:] == [post(1), post(2)] and said[-1] == 'SYNC_SUMMARY={"created": 0, "updated": 1, "unchanged": 1, "skipped": 0, "errors": 0}'
    back = {r.post_id: [b.text for b in r.blocks] for r in target.blocks_of(spark.table("job_target_children")).collect()}
    assert "다" in back["1"] and len(back) == 2 and spark.table("job_target").filter("changed").count() == 1
    pages[post(1)] = ("error", "")
    assert job.run(spark, settings, fetch, dt.date(2026, 8, 21), said.append) == 1
    pages[post(1)] = ("rate_limited", "")
    assert job.run(spark, settings, fetch, dt.date(2026, 8, 21), said.append) == 2


def test_hash_is_of_sorted_json_with_blocks_as_pairs(spark):
    import hashlib
    import json

    r = records(spark.createDataFrame([("https://s.example/archives/1", PAGE.format('가 "b"'))], "url string, html string"), "2026-08-12").first()
    plain = r.asDict(recursive=True)
    data = {n: plain[n] for n in HASHED} | {"body_blocks": [[b["kind"], b["text"]] for b in plain["body_blocks"]]}
    said = json.dumps(data, ensure_ascii=False, sort_keys=True, separators=(",", ":"), default=str)
    assert r.content_hash == hashlib.sha256(said.encode()).hexdigest()


def test_pages_are_parsed_once(spark):
    listing = spark.createDataFrame([(1, "https://s.example/d", "<div><a href='/archives/1'>x</a></div>"), (2, "https://s.example/d", "<a href='/archives/2'>x</a>")], "page_no int, page_url string, html string")
    got = listing_links(listing, "s.example")
    assert got._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert sorted((r.page_no, r.url[-1]) for r in got.collect()) == [(1, "1"), (2, "2")]


def test_inline_titles_are_found_as_without_the_look_ahead():
    import re

    from pagewright.functions import rules
    from pagewright.functions.vocabulary import SECTION_HEADINGS

    assert rules.INLINE_TITLE.startswith("(?=")
    plain = re.compile(rf"\[\s*(?:{rules.TITLES})\s*\]|(?:{rules.TITLES})", re.I)
    rng, titles = random.Random(7), [v for vs in SECTION_HEADINGS.values() for v in vs]
    for t in titles:
        assert rules.compiled(rules.INLINE_TITLE).search(t) and rules.compiled(rules.INLINE_TITLE).search(f"x[ {t.upper().replace(' ', '')} ]")
    for _ in range(500):
        text = "".join(rng.choice([*titles, "[", "]", "담당", "\u017f", "Q", "꼭"]) + rng.choice(["", " ", "\n", "x"]) for _ in range(12))
        for t in (text, text.swapcase(), text.replace(" ", "").replace("s", "\u017f")):
            assert [m.span() for m in rules.compiled(rules.INLINE_TITLE).finditer(t)] == [m.span() for m in plain.finditer(t)]


def test_pages_leave_in_parts():
    """A batch of any length is given out in parts; only the fields asked for are worked out, and no tree waits for the collector."""
    import gc

    import pandas as pd

    from pagewright.sources import html

    page = "<h1>T</h1><article><h1>T</h1><p>a<p>b<a href='/archives/1'>x</a></article>"
    n = 3 * html.TOGETHER + 1
    got = list(html.in_parts(pd.Series([page] * n), pd.Series(["https://s.example/"] * n), "", ("links",)))
    assert [len(p) for p in got] == [html.TOGETHER] * 3 + [1]
    assert all(list(p.columns) == ["links"] for p in got) and {r[0]["href"] for p in got for r in p["links"]} == {"https://s.example/archives/1"}
    every = parse_page(page, "https://s.example/")
    for fields in (("blocks",), ("had_images",), ("title", "categories"), ("apply_url", "next_href", "published_raw")):
        assert parse_page(page, "https://s.example/", fields=fields) == {k: every[k] for k in fields}
    gc.collect()
    gc.disable()
    try:
        parse_page(page, "https://s.example/")
        assert not any(isinstance(x, html.Node) for x in gc.get_objects())
    finally:
        gc.enable()


def test_page_tasks_follow_the_bytes(spark, tmp_path, monkeypatch):
    """Stored pages in one row group make as many tasks as their bytes need; rows that are not stored are read once."""
    from pagewright.plans import records as r

    rows = [(i, f"https://s.example/archives/{i}", f"<h1>{i}</h1>" + "<p>x" * 1000) for i in range(300)]
    table = spark.createDataFrame(rows, "page_id int, url string, html string")
    table.coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    monkeypatch.setattr(r, "TASK_BYTES", 50_000)
    for sf in (core.read(spark, str(tmp_path), "pages"), core.read(spark, str(tmp_path), "pages").unionByName(core.read(spark, str(tmp_path), "pages"))):
        n = sf.count()
        got = r.page_rows(sf, keep=("page_id",), fields=("title",))
        held = [x["count"] for x in got.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(held) == n and len(held) >= n * 4000 // 50_000 and max(held) <= 2 * n / len(held) + 1
        assert sorted(int(x.title) for x in got.collect()) == sorted(list(range(300)) * (n // 300))
    read = spark.sparkContext.accumulator(0)
    seen = spark.sparkContext.parallelize(rows[:40], 2).map(lambda x: (read.add(1), x)[1])
    got = r.page_rows(spark.createDataFrame(seen, "page_id int, url string, html string"), fields=("title",))
    assert read.value == 0 and len(got.collect()) == 40 and read.value == 40


def test_titles_and_links_need_no_blocks(spark, sf_dir, monkeypatch):
    """page_titles and first_seen_links ask for the fields that they return."""
    from pagewright.plans import records as r

    asked, parsed = [], r.parsed
    monkeypatch.setattr(r, "parsed", lambda html, url, site, fields: (asked.append(fields), parsed(html, url, site, fields))[1])
    core.queries()["page_titles"](spark, sf_dir)
    core.queries()["first_seen_links"](spark, sf_dir)
    assert asked == [("title",), ("links",)]


def test_remote_documents(spark):
    """Documents of a run in a store that forgets nothing: created once, then updated with their blocks replaced."""
    import json

    found = records(spark.createDataFrame([("https://s.example/archives/1", PAGE.format("".join(f"<br>{i} 줄" for i in range(250))))], "url string, html string"), "2026-08-12")
    docs = as_documents(target.properties(found, "2026-08-12"), target.child_blocks(found)).collect()
    batches = [json.loads(b) for b in docs[0].batches]
    assert [len(b) for b in batches] == [100, 100, 54] and batches[0][0]["texts"] == ["원문"] and json.loads(docs[0].properties)["post_id"] == "1"
    store, blocks, waits, asked = {}, {}, [], []

    def send(method, url, headers, body, timeout):
        asked.append((method, url))
        assert headers["Authorization"] == "Bearer t"
        data, path = json.loads(body) if body else {}, url.removeprefix("https://store.example").partition("?")[0].split("/")[1:]
        if path == ["documents", "query"]:
            return 200, {}, json.dumps({"results": [{"id": i} for i, d in store.items() if d["post_id"] == data["post_id"]]})
        if path == ["documents"]:
            store["d1"] = data
            return 200, {}, '{"id": "d1"}'
        if path[-1] == "children" and method == "PATCH":
            for b in data["children"]:
                blocks[f"b{len(asked)}-{len(blocks)}"] = b
        if path[-1] == "children" and method == "GET":
            every, at = list(blocks), int(url.partition("start_cursor=")[2] or 0)
            return 200, {}, json.dumps({"results": [{"id": i} for i in every[at : at + 100]], "has_more": at + 100 < len(every), "next_cursor": str(at + 100)})
        if method == "DELETE":
            del blocks[path[-1]]
        return 200, {}, ""

    client = RemoteClient("https://store.example/", "t", send_once=send, sleep=waits.append, clock=lambda: 0.0)
    put = lambda: client.put(docs[0].post_id, json.loads(docs[0].properties), batches)
    assert put() == "created" and len(blocks) == 254 and len(asked) == 5
    assert put() == "updated" and list(blocks.values()) == [b for part in batches for b in part] and len(store) == 1
    assert waits == [0.38] * (len(asked) - 1)  # every request but the first waits
    with pytest.raises(ValueError, match="token"):
        RemoteClient("https://store.example/", "")
