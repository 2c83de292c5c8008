"""Page order along the links, against a walk in Python."""

from __future__ import annotations

import json
import random
from collections import Counter
from pathlib import Path

from streetscape.sources.pages import LINK_DDL, ordered_pages, rank_pages, scan_capture_pages


def walk(links):
    """(file, request, next) -> {file: (chain, rank, status)} by following pointers one by one."""
    out, first = {}, {}
    for file, request, _ in sorted(links, key=lambda x: x[0]):
        if request is None:
            out[file] = (file, 0, None)
        elif request in first:
            out[file] = (None, None, "repeated_page")
        else:
            first[request] = file
    after = {r: next(n for f, q, n in links if f == first[r] and q == r) for r in first}
    lead = {}
    for r, n in after.items():
        if n is not None:
            lead[n] = min(lead.get(n, r), r)
    for r, file in first.items():
        seen, at, rank = {r}, r, 0
        while at in lead and lead[at] is not None:
            at, rank = lead[at], rank + 1
            if at in seen:
                at = None
                break
            seen.add(at)
        n = after[r]
        status = None if n is None else "missing_next" if n not in first else "forked" if lead[n] != r else None
        out[file] = (None, None, "cyclic") if at is None else (at, rank, status)
    return out


def ranked(spark, links):
    return {r.file: (r.chain, r.rank, r.status) for r in rank_pages(spark.createDataFrame(links, LINK_DDL)).collect()}


def test_chains_breaks_forks_cycles_and_repeats(spark):
    rng = random.Random(3)
    links = []
    names = [f"{rng.random()}" for _ in range(400)]
    for c, size in enumerate((1, 2, 3, 40, 100)):
        for k in range(size):
            links.append((names.pop(), f"u{c}-{k:03d}", f"u{c}-{k + 1:03d}" if k + 1 < size else None))
    links += [(names.pop(), f"cyc-{k}", f"cyc-{(k + 1) % 5}") for k in range(5)] + [(names.pop(), "self", "self")]
    links += [(names.pop(), "tail", "cyc-2"), (names.pop(), "aaa-into-cycle", "cyc-3")]
    links += [(names.pop(), "gap-0", "gap-1"), (names.pop(), "gap-1", "gone"), (names.pop(), "fork-b", "u3-020"), (names.pop(), "zz", "u3-021")]
    links += [("zzz-later-file", "u2-1", None), ("zzzz", "gap-0", "elsewhere"), (names.pop(), None, "u1-000"), (names.pop(), None, None)]
    rng.shuffle(links)
    got = ranked(spark, links)
    assert got == walk(links) and len(got) == len(links)
    assert {s for _, _, s in got.values()} == {None, "cyclic", "repeated_page", "missing_next", "forked"}


def test_empty_and_single(spark):
    assert ranked(spark, []) == {}
    assert ranked(spark, [("f", "a", None)]) == {"f": ("a", 0, None)}


def _land(folder, name, request, ids, after):
    page = {"data": [{"id": str(i)} for i in ids], "paging": {"next": after} if after else {}}
    (folder / name).write_text(json.dumps(page | ({"request": request} if request else {})))


def test_records_follow_the_links_not_the_files(spark, tmp_path):
    _land(tmp_path, "c.json", "u0", [1, 2], "u1")
    _land(tmp_path, "a.json", "u1", [3], "u2")
    _land(tmp_path, "b.json", "u2", [4, 5], "gone")
    _land(tmp_path, "d.json", "x", [9], "x")
    rows = scan_capture_pages(spark, str(tmp_path)).selectExpr("page", "pos", "try_variant_get(record, '$.id', 'string') AS id").orderBy("page", "pos").collect()
    assert [r.id for r in rows] == ["1", "2", "3", "4", "5"]
    assert sorted(tuple(r) for r in ordered_pages(spark, str(tmp_path))[1].collect()) == [("u2", "missing_next"), ("x", "cyclic")]


def test_pages_without_addresses_keep_their_paths(spark, tmp_path):
    _land(tmp_path, "b.json", None, [3], "u1")
    _land(tmp_path, "a.json", None, [1, 2], None)
    rows = scan_capture_pages(spark, str(tmp_path)).selectExpr("page", "pos", "try_variant_get(record, '$.id', 'string') AS id").orderBy("page", "pos").collect()
    assert [r.id for r in rows] == ["1", "2", "3"]


def test_linked_pages_land_as_files_of_one_folder(spark, tmp_path, monkeypatch):
    """no folder for each page (before: 20 folders, renamed one by one by the driver)."""
    from pyspark.sql import functions as F

    from streetscape.plans import layout_queries as L

    spark.range(2000).select(F.col("id").alias("event_id")).write.parquet(str(tmp_path / "events.parquet"))
    landed = []
    land = L.land_files
    monkeypatch.setattr(L, "land_files", lambda rows, path, *a, **k: landed.append((path, land(rows, path, *a, **k))))
    found = L.q_page_order(spark, str(tmp_path)).collect()
    (path, n), = landed
    assert n == 22 == len(found) == len(list(Path(path).glob("*.json")))
    told = Counter(r.status for r in found)
    assert (told["missing_next"], told["cyclic"], told["repeated_page"]) == (2, 4, 2)
    assert all(r.n_records == 100 for r in found)
