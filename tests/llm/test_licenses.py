import random
import re
import textwrap

from scoreloom.llm import licenses as lc

MIT = next(t for t in lc.TEMPLATES["MIT"] if t.startswith("Permission"))


def test_scan():
    assert lc.scan(None) == lc.scan("") == lc.scan("my driving licence expired") == []
    assert [r[0] for r in lc.scan(f"Copyright 2020 X\n{MIT}\nxx")] == ["MIT"]
    name, place, saved, differences, exact = lc.scan("foo Licensed under the Apache License, Version 1.1. baz")[0]
    assert (name, place, differences, exact) == ("Apache-2.0", 0, 0, True) and saved > 0
    changed = MIT.replace("free of charge", "at no cost").replace("to deal", "dealing")
    (name, _, _, differences, exact), = lc.scan(changed)
    assert name == "MIT" and 0 < differences < 10 and not exact
    assert [r[0] for r in lc.scan("Licensed under CC BY-SA 3.0.")] == ["CC-BY-SA"]
    assert lc.scan("She has a license to kill, and redistributed apples under the tree at the institute") == []


def test_documents(spark, docs):
    kinds = {"Apache-2.0": "Licensed under the Apache License", "MIT": "Released under the MIT License",
             "GPL": "licensed under the GNU General Public License", "CC-BY-NC": "Licensed under CC BY-NC"}
    want = {(r.doc_id, k) for r in docs.collect() for k, p in kinds.items() if re.search(p, r.text or "")}
    assert {(r.doc_id, r.license) for r in lc.found_licenses(docs).collect()} == want and want


def test_awkward(awkward):
    assert lc.found_licenses(awkward).count() == 0 == lc.found_licenses(awkward.limit(0)).count()


def test_every_template_is_compared():
    notice = ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License. Licensed under CC BY 4.0. "
              "Released under the MIT License. This work is licensed under the GNU General Public License, version 3. "
              "Licensed under the BSD 3-Clause License. Dedicated to the public domain under CC0 1.0.")
    assert [r[0] for r in lc.scan(notice)] == ["CC-BY-SA", "CC-BY", "MIT", "GPL", "BSD", "CC0"]
    filler = " ".join(f"word{i} and more of it" for i in range(20))
    chained = f" {filler} a license of sorts ".join([""] * 12 + ["Licensed under the BSD 3-Clause License."] + [""] * 12)
    assert [r[0] for r in lc.scan(chained)] == ["BSD"]


def test_each_place_gives_a_row():
    rows = lc.scan(f"{MIT} and, for the other part: {MIT} Licensed under CC BY 4.0. Licensed under CC BY 3.0.")
    assert [(r[0], r[3]) for r in rows] == [("MIT", 0), ("MIT", 0), ("CC-BY", 0), ("CC-BY", 0)]
    assert len({r[1] for r in rows}) == 4


def test_every_template_on_one_line_and_wrapped(spark):
    rows, want = [], []
    for name, texts in lc.TEMPLATES.items():
        for text in (t.replace("{", "").replace("}", "") for t in texts):
            wrapped = "\n".join(textwrap.wrap(text, 72))
            commented = "\n".join(f" * {line}" for line in textwrap.wrap(text, 60))
            for form in (text, wrapped, commented, f"{name} License\n\nCopyright (c) 2020 X\n\n{wrapped}\n\nMore text.\n"):
                want.append((len(rows), name, True))
                rows.append((len(rows), form))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.license, r.exact) for r in lc.found_licenses(df).collect()}
    assert got == set(want)


def test_reduction_decides():
    """By differences in wording the GPL notice would win; the LGPL one makes the block smaller and is tried first."""
    notice = next(t for t in lc.TEMPLATES["LGPL"] if t.startswith("This library")).replace("{", "").replace("}", "")
    text = notice.replace("This library", "This libraryware").replace("Lesser", "Lesser-known")
    words = lc._words(text)
    found = {name: lc.compare(words, template, slots)[0] for name, template, slots, _ in lc._templates()
             if len(template) > 30 and name in ("GPL", "LGPL")}
    assert found["GPL"] < found["LGPL"] <= lc.MAX_DIFFERENCE * len(words)
    assert [(r[0], r[3]) for r in lc.scan(text)] == [("LGPL", found["LGPL"])]


def every_reading(words):
    """(first, end, differences by word, licence) of each template at each place, without cues and compression."""
    out = []
    for name, template, slots, _ in lc._templates():
        for at in range(len(words)):
            differences, first, end = lc.compare(words[at: at + len(template) + lc._drift(template, slots)], template, slots)
            if differences <= lc.MAX_DIFFERENCE * len(template):
                out.append((at + first, at + end, differences / len(template), name))
    return out


def test_brute_force_over_templates_and_places():
    rng = random.Random(5)
    filler = "the of software copy license under use provided with any person work rights river stone blue notice".split()
    short = [(n, t.replace("{", "").replace("}", "")) for n, texts in lc.TEMPLATES.items() for t in texts if len(t) < 700]
    for _ in range(12):
        parts = []
        for _, text in rng.sample(short, 2):
            words = text.split()
            for _ in range(rng.randint(0, int(0.07 * len(words)))):  # another word counts twice
                words[rng.randrange(1, len(words) - 1)] = "other"
            parts += [" ".join(rng.choices(filler, k=rng.randint(3, 12))), " ".join(words)]
        text = " \n".join([*parts, "the end of it"])
        words = lc._words(text)
        places = [m.start() for m in lc._WORD.finditer(text)]
        readings, regions = every_reading(words), []
        for first, end, share, name in sorted(readings):
            if regions and first < regions[-1][1]:
                regions[-1][1] = max(end, regions[-1][1])
                regions[-1][2].append((share, name))
            else:
                regions.append([first, end, [(share, name)]])
        got = [(r[0], places.index(r[1])) for r in lc.scan(text)]
        assert len(got) == len(regions) == 2
        for (name, at), (first, end, found) in zip(got, regions, strict=True):
            assert at < end and name in {n for share, n in found if share == min(found)[0]}, (text, got, regions)


def test_whole_text_is_one_row():
    for name in ("MIT", "BSD", "ISC"):
        whole = max(lc.TEMPLATES[name], key=len)
        assert [(r[0], r[3]) for r in lc.scan(f"Copyright (c) 2020 X\n\n{whole}\n\nMore.")] == [(name, 0)]


def test_very_long_text():
    long = "license and copy of the software under any river " * 60_000 + MIT + " blue stone" * 100_000
    assert [(r[0], r[3]) for r in lc.scan(long)] == [("MIT", 0)]


def test_exact_wording_is_not_lost_to_a_rival():
    for before in ("seen there ththe onion %%% ", "river stone and blue notice of ", "1. 2. 3. "):
        row, = lc.scan(f"{before * 3}This work is licensed under the GNU General Public License, version 3. {before}")
        assert row[0] == "GPL" and row[4]
