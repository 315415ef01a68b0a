"""The licence scan's names, coverages and spans against a full alignment of every template with the whole text."""

import random
import re

from plain_models import full_alignment

from toolgraph.llm import license_scan

WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def spelt(text):
    return [(m[0].lower(), m.start(), m.end()) for m in WORD.finditer(text.encode())]


def best_by_full_alignment(text):
    """(template, matched, first byte, last byte) of the template with most words matched in order anywhere; of equals the shorter, then the narrower span, then the first name. None under the coverage."""
    words, found = spelt(text), []
    for name in sorted(license_scan.TEMPLATES):
        wanted = [w for w, _, _ in spelt(license_scan.TEMPLATES[name])]
        got = full_alignment(wanted, [w for w, _, _ in words])
        if got and got[0] >= license_scan.COVERAGE * len(wanted):
            matched, first, last = got
            found.append((-matched, len(wanted), last - first, name, words[first][1], words[last][2]))
    return min(found) if found else None


def scanned(spark, texts):
    rows = license_scan.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    return by


def test_names_and_spans_are_those_of_a_full_alignment(spark):
    rng = random.Random(6)
    around = [w for t in license_scan.TEMPLATES.values() for w in t.split(" ")]  # words that licences use
    texts, own = [], []
    for name in sorted(license_scan.TEMPLATES):
        for rate in (0.0, 0.1, 0.2, 0.3):
            words = [w if rng.random() >= rate else rng.choice([rng.choice(around), "other", ""]) for w in license_scan.TEMPLATES[name].split(" ")]
            texts.append(" ".join([*("before" for _ in range(rng.randint(0, 9))), *words, *("after" for _ in range(rng.randint(0, 9)))]))
            own.append((name, rate))
    by = scanned(spark, texts)
    named, spans, reached, mine = 0, 0, 0, {}
    for i, text in enumerate(texts):
        want = best_by_full_alignment(text)
        name, rate = own[i]
        # where the full alignment finds the template itself, so has the scan to
        if want is None:
            continue
        reached += 1
        top = min(by.get(i, []), key=lambda r: (-r.matched, r.coverage * -1), default=None)
        named += any(r.license == want[3] for r in by.get(i, []))
        spans += any((r.license, r.matched, r.start_byte, r.end_byte) == (want[3], -want[0], want[4], want[5]) for r in by.get(i, []))
        if want[3] == name:
            hits = mine.setdefault(rate, [0, 0])
            hits[0] += top is not None and top.license == name
            hits[1] += 1
    shares = {rate: a / b for rate, (a, b) in sorted(mine.items())}
    print(f"{reached} of {len(texts)} in reach; named as by the full alignment {named / reached:.3f}, span too {spans / reached:.3f}; own name where the full alignment has it: {shares}")
    assert named / reached >= 0.97 and spans / reached >= 0.95
    assert min(shares.values()) >= 0.9 and shares[0.0] == 1.0 and sum(b for _, b in mine.values()) > 150
