import pytest

from noticeloom.llm.history import verified
from noticeloom.llm.titles import same_subject

PAIRS = [
    ("energia solar", "enrgia solarr"),  # slips in every word
    ("saude mental indigena", "saud mentall indigena"),
    ("manejo solos tropicais", "manejosolostropicais"),  # lost blanks
    ("vacinas", "vacina"),
    ("energia solar", "turismo rural"),
    ("energia solar polo norte", "energia eolica polo sul"),
]


def test_nothing_is_dropped_that_the_closer_look_accepts(spark):
    got = verified(spark.createDataFrame(PAIRS, "a string, b string"), "a", "b").collect()
    assert {tuple(r) for r in got} == {p for p in PAIRS if same_subject(*p)} and len(got) == 4


@pytest.mark.parametrize("pair", PAIRS[4:])
def test_other_subjects(pair):
    assert not same_subject(*pair)
