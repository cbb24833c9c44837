"""Rules of the types, one case a rule, with scores written down by hand."""

import pytest
from pyspark.sql import functions as F

from tessera.operators.similarity import typed_similarity

CASES = [
    ("eligibility_criterion", {"identifier": "1", "category": "Inclusion"}, {"identifier": "1", "category": "inclusion"}, 1.0),
    ("eligibility_criterion", {"identifier": "1", "category": "Inclusion"}, {"identifier": "1", "category": "Exclusion"}, 0.9),
    ("eligibility_criterion", {"identifier": "1", "category": "x"}, {"identifier": "2", "category": "x"}, 0.0),
    ("eligibility_criterion", {"identifier": None}, {"identifier": None}, 0.0),
    ("encounter", {"name": "Day -21", "label": ""}, {"name": "Visit -21"}, 0.9),
    ("encounter", {"name": "Screening", "label": None}, {"name": "screening visit"}, 0.8),
    ("encounter", {"name": "abcd"}, {"name": "abcx"}, 0.75),
    ("epoch", {"name": "Screening a"}, {"name": "Screening"}, 0.85),
    ("epoch", {"name": "Part one"}, {"name": "Part"}, 0.8),
    ("epoch", {"name": "Follow-up"}, {"name": "EOS"}, 0.8),
    ("epoch", {"name": "abcd"}, {"name": "xbcd"}, 0.75),
    ("study_arm", {"name": "15 mg then 30 mg"}, {"name": "30 mg / 15 mg"}, 0.95),
    ("study_arm", {"name": "15 mg"}, {"description": "15mg daily"}, 0.85),
    ("study_arm", {"name": "Treatment A"}, {"name": "treatment b"}, 0.8),
    ("study_arm", {"name": "ab", "type": "Arm X"}, {"name": "cd", "type": "Other arm"}, 0.75),
    ("indication", {"name": "Wilson disease"}, {"name": "a disease"}, 0.85),
    ("timing", {"value": "P7D"}, {"value": "P7D"}, 0.9),
    ("timing", {"value": "P42D", "valueLabel": "42 Days"}, {"value": "P6W", "label": "Day 42"}, 0.8),
    ("timing", {"label": "baseline"}, {"label": "Baseline now"}, 0.75),
    ("abbreviation", {"abbreviatedText": "AE"}, {"abbreviatedText": "ae"}, 1.0),
    ("abbreviation", {"abbreviatedText": "AE", "expandedText": "abcd"}, {"abbreviatedText": "SAE", "expandedText": "abcx"}, 0.75),
    ("objective", {"text": None, "name": "abcd"}, {"text": "abcx", "name": "other"}, 0.75),
    ("objective", {"text": ""}, {"text": None}, 1.0),
]


@pytest.mark.parametrize("kind", sorted({c[0] for c in CASES}))
def test_rules(spark, kind):
    own = [c for c in CASES if c[0] == kind]
    score = [typed_similarity(kind, *({f: F.lit(v).cast("string") for f, v in r.items()} for r in c[1:3])).alias(f"s{i}") for i, c in enumerate(own)]
    got = spark.range(1).select(*score).first()
    assert [round(x, 6) for x in got] == [c[3] for c in own]
