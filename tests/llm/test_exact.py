from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

from llm.conftest import lowered
from torqline.llm.exact import digest_groups, without_copies


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[lowered(text)].append(doc_id)
    return groups


def test_groups_match_brute_force(docs, rows):
    groups = brute(rows)
    for fan_in in (2, 16):
        got = digest_groups(docs, fan_in=fan_in).collect()
        assert len(got) == len(rows)
        by_sha = {hashlib.sha256(t.encode()).digest(): ids for t, ids in groups.items()}
        kept = Counter()
        for r in got:
            ids = by_sha[bytes(r["sha"])]
            known = [i for i in ids if i is not None]
            assert r["keep_id"] == (max(known) if known else None) and r["group_size"] == len(ids)
            if r["kept"]:
                assert r["doc_id"] == r["keep_id"]
                kept[bytes(r["sha"])] += 1
        assert set(kept.values()) == {1} and len(kept) == len(groups)


def test_kept_rows_keep_all_columns(docs, rows):
    got = without_copies(docs)
    assert got.columns == docs.columns
    got = got.collect()
    groups = brute(rows)
    assert sorted(lowered(r["text"]) for r in got) == sorted(groups)
    assert {r["Score"] for r in got} == {0.25}


def test_empty_table(nothing):
    assert digest_groups(nothing).count() == 0
    assert without_copies(nothing).count() == 0
