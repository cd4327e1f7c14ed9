"""The encoder takes units of letters for one match each: the pattern must agree for every letter."""

import public_tokenizers
import regex


def test_letters_are_one_match():
    pattern = regex.compile(public_tokenizers.PATTERN)
    letters = [chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000 and chr(i).isalpha()]
    assert not [c for c in letters if pattern.findall(c) != [c]]
    for start in range(0, len(letters), 997):
        unit = "".join(letters[start : start + 997])
        assert unit.isalpha() and pattern.findall(unit) == [unit] and pattern.findall(" " + unit) == [" " + unit]
