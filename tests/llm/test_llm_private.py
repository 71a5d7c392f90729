"""Cards next to other numbers, and names in running text."""

import re

import pytest
from kinomart.llm import pii

KEY = b"a key of the tests"

CARD, OTHER = "4111111111111111", "5500 0000 0000 0004"


@pytest.mark.parametrize("rest", [" 123", " 12/27", " 12/27 123", f" {OTHER}", f" 123 {OTHER}", " 12345", "-123"])
def test_cards_beside_numbers(rest):
    for card in (CARD, "4111 1111 1111 1111", "2223003122003222", "2200 0000 0000 0004"):
        new, kinds = pii.replace(f"pay {card}{rest} now", {}, 5, KEY)
        expected = f"pay {pii.surrogate('card', card, KEY)}{rest} now".replace(OTHER, pii.surrogate("card", OTHER, KEY))
        assert new == expected and card not in new
        assert set(kinds) == {"card"} and len(kinds) == 1 + (OTHER in rest)
        assert pii._is("card", pii.surrogate("card", card, KEY))


def test_cards_behind_numbers_and_numbers_that_are_none():
    for front in ("345", "345 678", "12", "5000"):
        for card in (CARD, "4111 1111 1111 1111"):
            assert pii.replace(f"{front} {card} x", {}, 5, KEY)[0] == f"{front} {pii.surrogate('card', card, KEY)} x"
    for text in ("from 2024-01-15 2024-01-16 on", "4111111111112", "3 4 5"):
        assert pii.replace(text, {}, 5, KEY) == (text, [])


def _last(name):
    return pii.surname(name, 0, 5, KEY)


def test_later_mentions_of_first_names():
    a = pii.first_name("Anna", KEY)
    new, kinds = pii.replace("Anna Mueller came. Anna spoke, and Annabel left. Dr. Anna too.", {}, 5, KEY)
    assert new == f"{a} {_last('Mueller')} came. {a} spoke, and Annabel left. Dr. {a} too." and kinds == ["name"] * 4
    new, _ = pii.replace("Paul Martin met Martin Weber. Martin smiled.", {}, 5, KEY)
    assert new == f"{pii.first_name('Paul', KEY)} {_last('Martin')} met {pii.first_name('Martin', KEY)} {_last('Weber')}. {_last('Martin')} smiled."


def test_white_space_and_titles():
    for gap in ("  ", "\n", " \n  ", "\t"):
        assert pii.replace(f"Anna{gap}Mueller", {}, 5, KEY)[0] == f"{pii.first_name('Anna', KEY)}{gap}{_last('Mueller')}"
    for title in ("Dr.", "Prof.", "Herr Dr.", "Prof. Dr.", "Miss", "Mr", "Mrs."):
        assert pii.replace(f"{title} Weber spoke.", {}, 5, KEY)[0] == f"{title} {_last('Weber')} spoke."
        new = pii.replace(f"{title} Ottilie Weber spoke. Ottilie left.", {}, 5, KEY)[0]
        assert new == f"{title} {_last('Ottilie')} {_last('Weber')} spoke. {_last('Ottilie')} left."
    assert re.match(r"I saw \w+\nThe next day the \w+ came", pii.replace("I saw Anna\nThe next day the Man came", {}, 5, KEY)[0])
    for name in ("Wolfgang", "Jürgen", "Владимир", "Jennifer"):
        assert pii.replace(f"{name} Abc", {}, 5, KEY)[0] == f"{pii.first_name(name, KEY)} {_last('Abc')}"
