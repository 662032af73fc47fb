from parcelpulse.llm import license_scan as ls


def _scan(text, coverage=0.8):
    return ls.scanner(tuple(ls.TEMPLATES.items()), coverage).scan(text)


def test_patience_alignment_increases_and_matches():
    a, b = "x a b c q d d e".split(), "a b z c d e e".split()
    pairs = ls.align(a, b)
    assert all(a[i] == b[j] for i, j in pairs)
    assert pairs == sorted(pairs) and len({i for i, _ in pairs}) == len(pairs) == len({j for _, j in pairs}) == 5
    assert ls.increasing([3, 1, 2, 5, 4]) in ([1, 2, 4], [1, 2, 3])


def test_notices_anywhere_and_more_than_once():
    mit, line = ls.TEMPLATES["MIT"], "Released under the MIT License."
    filler = "the of and a to in software " * 400
    text = f"{filler}{mit}\n{filler}{line} {filler}{mit.replace('granted', 'given')}"
    found = _scan(text)
    assert [m.license for m in found] == ["MIT", "MIT line", "MIT"]
    assert text[found[0].start : found[0].stop] == mit[:-1] and found[0].coverage == 1
    assert 0.9 < found[2].coverage < 1
    assert text[found[1].start : found[1].stop] == line[:-1]


def test_reworded_and_wrapped_text_is_still_covered():
    words = ls.TEMPLATES["Apache-2.0"].split()
    changed = [w for i, w in enumerate(words) if i % 12]
    text = "\n * ".join(" ".join(changed[i : i + 7]) for i in range(0, len(changed), 7))
    assert "Apache-2.0" in [m.license for m in _scan(text)]
    assert not _scan("a work about licenses under the general public eye " * 50)


def test_rows_keep_their_ids(docs):
    line = "Licensed under the Apache License, Version 2.0."
    out = ls.scan_licenses(docs([(None, line), (1, None), (1, ""), (2, line * 2), (2, line * 2), (3, "é " * 50_000)])).collect()
    assert sorted((str(r.doc_id), len(r.matches)) for r in out) == [("1", 0), ("1", 0), ("2", 2), ("2", 2), ("3", 0), ("None", 1)]
    assert ls.scan_licenses(docs([(1, "a")]).limit(0)).count() == 0


def test_copies_side_by_side_are_all_found():
    line, mit = ls.TEMPLATES["Apache-2.0 line"], ls.TEMPLATES["MIT"]
    for name, body, word, other in [("Apache-2.0 line", line, "under", "by"), ("MIT", mit, "granted", "given"), ("MIT", mit, "sell", "trade")]:
        edited = body.replace(word, other)
        for copies in ([body] * 2, [body] * 3, [edited, body], [body, edited], [edited] * 2, [body, edited, body], [edited, body, body]):
            for before, between in (("See: ", " "), ("", " "), ("Copyright A ", " Copyright B "), ("word " * 500, " ")):
                text = before + between.join(copies)
                found = [m for m in _scan(text) if m.license == name]
                assert [text[m.start : m.stop] for m in found] == [c.rstrip(".") for c in copies]
                assert [m.matched for m in found] == [m.of - (c is edited) for m, c in zip(found, copies)]


def test_copies_with_different_edits_do_not_mix():
    line = ls.TEMPLATES["Apache-2.0 line"]
    copies = [line.replace("Version", "Edition"), line.replace("under", "beneath")]
    text = "See " + " ".join(copies)
    assert [text[m.start : m.stop] + "." for m in _scan(text)] == copies


def test_common_subsequence_is_longest():
    import random

    random.seed(3)
    for _ in range(300):
        a, b = (random.choices("abcd", k=random.randint(0, 12)) for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        pairs = ls._common_subsequence(a, b)
        assert len(pairs) == best[-1][-1] and all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))


def test_no_other_licence_is_named():
    told = {
        "Released under the BSD License": {"BSD line"}, "Released under the Foo License": set(), "Released under the BSD 3-Clause License": {"BSD-3-Clause line"},
        "Licensed under CC BY 4.0": {"CC-BY line"}, "Licensed under CC BY-SA 4.0": {"CC-BY-SA short line"}, "Licensed under CC BY-NC 4.0": {"CC-BY-NC line"},
        "Licensed under CC BY-NC-SA 4.0": {"CC-BY-NC-SA line"}, "Licensed under the Apache License, Version 1.1": set(),
        "Licensed under the GNU Lesser General Public License, version 3": {"LGPL-3.0 line"}, "Licensed under the MIT License": {"MIT line"},
        "This work is licensed under the GNU General Public License, version 2": {"GPL-2.0 line"},
        "This work is licensed under a Creative Commons Attribution 4.0 International License": {"CC-BY long line"},
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License": {"CC-BY-NC-SA long line"},
        "The work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License": {"CC-BY-NC long line"},
    }
    assert {t: {m.license for m in _scan(f"Intro words. {t}. More words")} for t in told} == told


def test_every_template_names_itself():
    for name, body in ls.TEMPLATES.items():
        found = {m.license: m for m in _scan(f"Some words first. {body} And some after.")}
        assert found[name].coverage == 1
        near = {"Apache-2.0", "Apache-2.0 line", "GPL", "GPL-2.0", "LGPL-2.1", "MPL-2.0", "MPL-2.0 line", name}
        assert set(found) <= near | ({"LGPL-3.0"} if name == "LGPL-3.0 text" else set()), (name, set(found))


def test_whole_texts_with_edits():
    for name in ("GPL-3.0", "GPL-2.0", "LGPL-2.1", "Apache-2.0", "MPL-2.0"):
        words = ls.TEMPLATES[f"{name} text"].split()
        edited = " ".join(w for i, w in enumerate(words) if i < 60 or i % 25)
        found = [m for m in _scan(f"{edited}\n{edited}") if m.license.endswith(" text")]
        assert [m.license for m in found] == [f"{name} text"] * 2 and all(m.coverage > 0.9 for m in found)
