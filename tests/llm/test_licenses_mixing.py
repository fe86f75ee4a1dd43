import hashlib
import random
import textwrap

from reelforge.llm import licenses, mixing
from tests.llm.helpers import documents, words


def test_every_template_is_found_in_prose():
    rng, t = random.Random(3), licenses.Templates()
    for name, sentences in licenses.TEMPLATES.items():
        for s in sentences:
            found = t.find(f"{words(rng, 30)}.\n{s}\n{words(rng, 30)}.")
            shared = {k for k, v in licenses.TEMPLATES.items() if s in v}  # two BSD licenses have sentences in common
            assert {f[0] for f in found} & shared and all(f[4] == "exact" for f in found if f[0] in shared), (name, s, found)


def test_one_changed_word_is_found():
    t = licenses.Templates()
    for name, sentences in licenses.TEMPLATES.items():
        for s in sentences:
            part = s.split()
            for k in range(len(part)):
                if len(part) >= 12:
                    found = t.find(" ".join([*part[:k], "changed", *part[k + 1 :]]))
                    # where the changed word is the one that tells two licenses apart, the other one may be nearer
                    assert found and (any(s in licenses.TEMPLATES[f[0]] for f in found) or part[k] in ("Affero", "Attribution-ShareAlike", "Attribution-NonCommercial")), (name, s, k)
    clause = "Neither the name of the owner holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
    assert [(f[0], f[4], f[5]) for f in t.find(clause)] == [("BSD-3-Clause", "near", "-copyright+owner")]


def test_blocks_against_the_whole_text():
    """Windows lose nothing: every sentence of every template that brute force confirms in the whole text is found."""
    rng, t = random.Random(12), licenses.Templates()
    every = [(k, s) for k, v in licenses.TEMPLATES.items() for s in v]
    common = " ".join(s for _, s in every).lower().split()
    for n in range(200):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            parts += [words(rng, rng.randrange(0, 300)), " ".join(rng.choice(common) for _ in range(rng.randrange(60)))]
            w = rng.choice(every)[1].split()
            for _ in range(rng.choice([0, 0, 1, 2])):
                w[rng.randrange(len(w))] = "other"
            parts.append(" ".join(w))
        text = "\n".join(parts)
        whole = {k for k in t.names for _ in t.wording(licenses._words(text), k)}
        inside = {k for a, b in t.candidates(text) for k in t.names for _ in t.wording(licenses._words(text[a:b]), k)}
        assert whole == inside, (n, whole ^ inside)
        assert {f[0] for f in t.find(text)} <= whole and bool(t.find(text)) == bool(whole)


def test_full_texts_of_two_bsd_licenses():
    t = licenses.Templates()
    for name in ("BSD-2-Clause", "BSD-3-Clause", "MIT", "Zlib"):
        text = "\n\n".join(licenses.TEMPLATES[name][2:])
        assert {f[0] for f in t.find(text)} == {name}, t.find(text)


def test_near_wording_is_reported():
    t = licenses.Templates()
    text = "The above copyright notice and this permission notice must be included in all copies or substantial portions of the Software."
    (name, a, b, saved, kind, diff), = t.find(text)
    assert (name, kind) == ("MIT", "near") and "shall" in diff and "must" in diff and saved > 0.3 and text[a:b] == text


def test_no_license_in_clean_text(spark):
    rows = [(1, words(random.Random(1), 500)), (2, None), (3, "a driving licence is needed. " * 400), (4, "All rights reserved.")]
    got = {r["doc_id"]: r for r in licenses.scan(documents(spark, rows)).collect()}
    assert got[1]["n_blocks"] == 0 and got[3]["n_found"] == 0 and got[4]["licenses"] == "proprietary"


def test_short_notices_in_long_blocks():
    rng, t = random.Random(4), licenses.Templates()
    for around in (0, 60, 100, 230, 500):
        prose = words(rng, around)
        half = len(prose) // 2
        for name, notice in (("Apache-2.0", "licensed under the Apache License, Version 2.0"), ("proprietary", "all rights reserved"), ("CC-BY-4.0", "licensed under CC BY 4.0")):
            assert (name, "exact") in {(f[0], f[4]) for f in t.find(f"{prose[:half]} {notice} {prose[half:]}")}, (name, around)


def test_every_license_of_a_block_is_found():
    t = licenses.Templates()
    text = "Released under the MIT License. Licensed under the Apache License, Version 2.0."
    assert [(f[0], text[f[1] : f[2]], f[4]) for f in t.find(text)] == [("MIT", text[:31], "exact"), ("Apache-2.0", text[32:], "exact")]
    for names in (("GPL-2.0", "GPL-3.0"), ("MIT", "BSD-3-Clause", "ISC", "MPL-2.0"), ("CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0")):
        text = " ".join(licenses.TEMPLATES[n][-1] for n in names)
        found = t.find(text)
        assert [f[0] for f in found] == list(names) and {f[4] for f in found} == {"exact"}, found
    # the same words are not given to two templates
    for name in ("GPL-2.0", "GPL-3.0", "CC-BY-4.0", "CC-BY-SA-4.0"):
        for s in licenses.TEMPLATES[name]:
            assert [f[0] for f in t.find(s)] == [name], s
    assert [f[0] for f in t.find("Released under the Apache License, Version 2.0.")] == ["Apache-2.0"]
    assert [f[0] for f in t.find("Released under the MIT Licence. All rights reserved.")] == ["MIT", "proprietary"]


def test_wrapped_license_texts():
    """Every template sentence in lines of several widths, plain and as comments, between prose in the same paragraph."""
    rng, t = random.Random(5), licenses.Templates()
    assert max(len(s) for v in t.sentences.values() for s in v) <= licenses.LEAST_RATIO * licenses.REACH and 2 * licenses.REACH <= licenses.OVERLAP
    for name in ("MIT", "BSD-3-Clause", "ISC", "Apache-2.0", "GPL-3.0"):
        for s in licenses.TEMPLATES[name]:
            if licenses._words(s)[0] == licenses.TAG:
                continue
            for width in (40, 72, 80):
                for sign, end in (("", "\n"), ("# ", "\n"), (" * ", "\r\n"), ("    // ", "\n")):
                    lines = textwrap.wrap(f"{words(rng, 200)} {s} {words(rng, 200)}", width, break_on_hyphens=False, break_long_words=False)
                    found = t.find("".join(f"{sign}{x}{end}" for x in lines))
                    assert any(s in licenses.TEMPLATES[f[0]] for f in found if f[4] == "exact"), (s, width, sign)


def test_blocks_of_very_long_texts():
    """A text that is one run of hits is cut into windows that cover it, and a notice at any place is found."""
    rng, t = random.Random(7), licenses.Templates()
    text = "a copy of this software and " * 2000 + "Released under the MIT License. " + "in the Software without " * 3000
    blocks = t.candidates(text)
    assert blocks[0][0] == 0 and blocks[-1][1] >= len(text) - 1 and all(y[0] < x[1] for x, y in zip(blocks, blocks[1:]))
    assert ("MIT", "exact") in {(f[0], f[4]) for f in t.find(text)}
    assert t.candidates(words(rng, 5000)) == []


def test_spdx_lines():
    t = licenses.Templates()
    for line, names in (("MIT", ["MIT"]), ("GPL-3.0-or-later", ["GPL-3.0"]), ("(MIT OR Apache-2.0) AND CC0-1.0", ["MIT", "Apache-2.0", "CC0-1.0"]), ("X11", [])):
        assert [f[0] for f in t.find(f"// SPDX-License-Identifier: {line}\nint main or MIT")] == names, line


def water(sizes, weights=(5, 2, 1)):
    """Targets by sharing and resharing, step by step."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    w = {s: weights[k % 3] for k, s in enumerate(names)}
    left, full = 1.5 * sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in full]
        pool = left - sum(2 * sizes[s] for s in full)
        share = {s: pool * w[s] / sum(w[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 2 * sizes[s]}
        if not over:
            return {s: float(2 * sizes[s]) if s in full else share[s] for s in names}
        full |= over


def test_mixing_against_resharing(spark):
    rng = random.Random(6)
    rows = [(i, words(rng, rng.randrange(0, 60)), rng.choice(["a", "b", "é", "z", "Z", None, "", "hot", "hot", "hot"])) for i in range(600)]
    got = mixing.mix(documents(spark, rows)).collect()
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(t.split())
    targets = water(sizes)
    for r in got:
        assert abs(r["target"] - targets[r["source"]]) < 1e-6 and r["source_size"] == sizes[r["source"]]
        rate = targets[r["source"]] / sizes[r["source"]]
        draw = int(hashlib.md5(f"mix:{r['doc_id']}".encode()).hexdigest()[:8], 16) / 2**32
        assert r["copies"] == int(rate) + (draw < rate - int(rate))
    taken = sum(r["size"] * r["copies"] for r in got)
    assert abs(taken / (1.5 * sum(sizes.values())) - 1) < 0.1
