"""The classifier reads the shape of a whole word, however long."""

import pytest

from muster.llm import classifier


@pytest.mark.parametrize("start", ["日本" * 40, "a" * 70, "Ab" * 40])
def test_shape_sees_past_64_characters(start):
    places = classifier._Places()
    shapes = {classifier.read(start + end, places)[1][0] for end in ("", "12", "12X", "!?#")}
    assert len(shapes) == 4
    assert classifier._shape(start + "12") == classifier._shape(start) + "9"
    assert start + "12" not in places


def test_plain_words_have_the_shape_of_the_slow_way():
    for word in ("tree,", "Tree.", "x" * 80 + ",", "X" + "y" * 80 + "!", "tree"):
        place = classifier.zlib.crc32(classifier._shape(word).encode()) % (classifier.SHAPES - 1) + 1
        assert classifier.read(word, classifier._Places())[1][0] == place
