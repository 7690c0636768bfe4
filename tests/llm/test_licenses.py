import random
import re

import helpers
import pytest

from salescast.llm.license_rules import LICENCES, rules
from salescast.llm.licenses import PHRASES, Scanner, scan_licences

SCANNER = Scanner()


@pytest.mark.parametrize("text, labels", [
    ("Licensed under the Apache License, Version 2.0.", ["apache-2"]),
    ("This work is licensed under the GNU General Public License, version 3.", ["gpl-3"]),
    ("Released under the MIT License.", ["mit"]), ("Licensed under CC BY-NC 4.0.", ["cc-by-nc"]),
    ("GNU Lesser General Public License v2.1 or later", ["lgpl-2.1"]), ("SPDX-License-Identifier: GPL-2.0-or-later", ["gpl-2"]),
    ("Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International", ["cc-by-nc-sa"]),
    ('"license": "BSD-3-Clause"', ["bsd-3"]), ("https://www.apache.org/licenses/LICENSE-2.0", ["apache-2"]),
    ("GNU Affero General Public License", ["agpl-3"]), ("Lost mit der Mit.", []), ("admitted license", []), ("accident by nc", []),
    ("THE MIT LICENSE and the Zlib license", ["mit", "zlib"]), ("", []),
    ("GPLv2 or later", ["gpl-2"]), ("LGPLv2.1", ["lgpl-2.1"]), ("AGPLv3", ["agpl-3"]), ("the WTFPL", ["wtfpl"]), ("GNU GPL v3", ["gpl-3"]),
    ("SPDX-License-Identifier: (MIT OR Apache-2.0)", ["apache-2", "mit"]), ("SPDX-License-Identifier: MIT AND (ISC OR Zlib)", ["isc", "mit", "zlib"]),
    ("// SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0 OR MIT", ["gpl-2", "mit"]),
    ("Licensed under the Apache License", ["apache"]), ("please cc by mail", []), ("shared under CC BY 4.0", ["cc-by"]), ("CC BY, see below", ["cc-by"]),
])
def test_labels(text, labels):
    assert sorted({m[0] for m in SCANNER.matches(text)}) == labels


def test_suppression_equals_all_pairs():
    rng = random.Random(4)
    parts = ["licensed under the", "GNU General Public License", "version 2", "MIT License", "Apache License, Version 2.0", "GPL", "under the terms of the",
             "all rights reserved", "SPDX-License-Identifier: MIT OR ISC", "BSD License", "\n", "text", "CC BY-NC 4.0", "Lesser"]
    for _ in range(400):
        text = " ".join(rng.choice(parts) for _ in range(rng.randint(1, 20)))
        found = [(-rule.weight, m.start(g) - m.end(g), number, *m.span(g), rule.label) for number, rule in enumerate(rules())
                 for g in [1 if rule.pattern.groups else 0] for m in rule.pattern.finditer(text)]
        want = []
        for weight, _, _, start, end, label in sorted(found):
            if not any(a <= start and end <= b for _, a, b, _ in want):
                want.append((label, start, end, -weight))
        assert SCANNER.matches(text) == sorted(want, key=lambda m: m[1:])


def test_many_matches_in_one_text_take_linear_time():
    import time

    SCANNER.matches("All rights reserved. " * 1000)
    start = time.process_time()
    found = SCANNER.matches("All rights reserved.\n" * 100_000)
    assert len(found) == 100_000 and time.process_time() - start < 20


def test_hundreds_of_ordered_rules():
    found = rules()
    assert len(found) > 300 and [r.weight for r in found] == sorted((r.weight for r in found), reverse=True)
    assert {r.label for r in found} >= set(LICENCES)


def test_containment_keeps_the_heavier():
    (one,) = SCANNER.matches("distributed under the terms of the GNU General Public License version 2")
    assert one[0] == "gpl-2" and one[3] == 90


def test_base_phrases_equal_brute_force(spark):
    rng = random.Random(6)
    words = "under the MIT license apache version 2 cc by nc x".split()
    docs = [(i, "".join(rng.choice(words) + rng.choice([" ", ", ", "-"]) for _ in range(rng.randint(0, 120)))) for i in range(60)]
    docs += [(90, "Under the MIT-License"), (91, "apache license, version 2."), (92, "CC BY-NC"), (93, None), (94, ""), (None, "cc by nc"),
             (95, "y " * 20_000 + "cc by nc"), (95, "cc by"), (96, "under the mit"), (97, "license")]
    want = []
    for doc_id, text in docs:
        own, found = helpers.letters(text), []
        for phrase, label in PHRASES.items():
            parts = phrase.split()
            found += [(k, label) for k in range(len(own)) if own[k: k + len(parts)] == parts]
        places = sorted(k for k, _ in found)
        want.append((doc_id, len(own), len(found), places[0] if places else None, places[-1] if places else None,
                     sorted({label for _, label in found})))
    got = scan_licences(helpers.documents(spark, docs).repartition(2)).select("doc_id", "licences.*").collect()
    assert sorted((tuple(r[:6]) for r in got), key=repr) == sorted(want, key=repr)
    for r in got:
        assert set(r.base_labels) <= set(r.labels) and 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)


def test_empty_table(spark):
    assert scan_licences(helpers.documents(spark, [])).count() == 0


def _made(parsed, rng):
    """A text that a parsed pattern matches, with line breaks and more as white space."""
    out = ""
    for kind, value in parsed:
        kind = str(kind)
        if kind == "LITERAL":
            out += chr(value)
        elif kind == "BRANCH":
            out += _made(rng.choice(value[1]), rng)
        elif kind == "SUBPATTERN":
            out += _made(value[3], rng)
        elif kind in ("MAX_REPEAT", "POSSESSIVE_REPEAT"):
            out += "".join(_made(value[2], rng) for _ in range(rng.randint(value[0], min(value[1], value[0] + 2))))
        elif kind == "IN":
            kinds = {(str(k), str(v)) for k, v in value}
            if ("CATEGORY", "CATEGORY_SPACE") in kinds:
                out += rng.choice([" ", "\n", "\n    ", "\t"])
            elif ("CATEGORY", "CATEGORY_WORD") in kinds:
                out += rng.choice("xyz")
            elif ("CATEGORY", "CATEGORY_DIGIT") in kinds:
                out += rng.choice("0123456789")
            else:
                k, v = rng.choice(value)
                out += chr(v if str(k) == "LITERAL" else rng.randint(*v))
        elif kind == "ANY":
            out += rng.choice("xyz ")
    return out


def test_every_rule_is_tried_where_it_matches():
    rng = random.Random(9)
    for number, rule in enumerate(rules()):
        good = 0
        for _ in range(40):
            text = f"* {_made(re._parser.parse(rule.pattern.pattern, rule.pattern.flags), rng)}\n*"
            text = rng.choice([text, text.upper(), text.title()])
            if rule.pattern.search(text):
                good += 1
                low = " ".join(text.lower().split())
                assert any(all(part in low for part in parts) for parts in rule.keywords), (rule, text)
        assert good, rule


@pytest.mark.parametrize("text, label", [
    ("licensed under GPLv3", "gpl-3"), ("the Expat License", "mit"), ("see unlicense.org", "unlicense"), ("see eupl.eu", "eupl"),
    ("see wtfpl.net", "wtfpl"), ("the GNU General\nPublic License, version\n   2", "gpl-2"),
    ("Permission is hereby\n granted, free of charge, to any person obtaining\na copy", "mit"), ("Creative Commons\nAttribution", "cc-by"),
    ("neither the name of the\nholder nor the names of its contributors may be used to endorse or promote", "bsd-3"),
    ("public domain" + " " * 100_000 + "mozilla public license" + "\n" * 100_000 + "MPL", "mpl"),
])
def test_alternatives_and_wrapped_notices(text, label):
    assert label in {m[0] for m in SCANNER.matches(text)}
