import datetime as dt
import json
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from strata.session import get_session
    s = get_session("local[4]", 4)
    yield s


@pytest.fixture()
def tmp_root():
    return tempfile.mkdtemp(prefix="strata-test-")


def card(cid, name, **fields):
    """A card document with an id and a name; every test adds the fields that it checks."""
    return {"id": cid, "name": name, **fields}


def price(updated, **finishes):
    return {"url": "https://shop.example", "updatedAt": updated, "prices": finishes}


def kite_set(**over):
    """A set object whose fields the set rules need (dates as text, images present)."""
    return {"id": "kite", "name": "Kite", "series": "Loop", "printedTotal": 3, "total": 4, "ptcgoCode": "KT",
            "releaseDate": "2015/06/07", "updatedAt": "2016/08/09 10:11:12",
            "images": {"symbol": "sym", "logo": "log"}, **over}


def make_cards():
    """Four cards, each made for the rules under test: three generations of one line (the set's time text
    cut off in one of them, a price too old in another) and one card with an unknown parent, no
    rarity, no set images and no legalities."""
    two = price("2026/01/15", plain={"low": 1.0, "high": 9.0, "market": 6.5}, foil={"low": 4.0, "high": 8.0, "market": 7.25})
    owl = card("k-1", "Owl", evolvesFrom="Fledgling", hp="75", supertype="Bird", subtypes=["Third"], types=["Sky"], number="1",
               attacks=[{"name": "Peck", "cost": ["Sky", "sky", "Stone"], "convertedEnergyCost": 3, "damage": "15"},
                        {"name": "Dive", "cost": ["Stone"], "convertedEnergyCost": 1, "damage": " "}],
               weaknesses=[{"type": "Frost", "value": "×9"}], retreatCost=["Sky", "Stone"], set=kite_set(),
               nationalPokedexNumbers=[7], legalities={"unlimited": "Legal"}, rarity="Shiny", flavorText="Hoot.", tcgplayer=two)
    fledgling = card("k-2", "Fledgling", evolvesFrom="Egg", number="TG12", rarity="Plain", legalities={"standard": "Legal", "unlimited": "Legal"},
                     set=kite_set(updatedAt="016/08/10 09:00:00"), attacks=[{"name": "Nothing", "cost": []}],
                     abilities=[{"name": "Nap", "text": "Rests."}],
                     tcgplayer=price("2026/01/14", plain={"low": 1.0, "high": 3.0}, unheard={}))
    egg = card("k-3", "Egg", number="!", set=kite_set(), legalities={}, tcgplayer=price("2025/12/01", plain={"market": 1.5}))
    stray = card("m-1", "Stray", evolvesFrom="Nobody", number="12a", set={"id": "moor", "name": "Moor"}, tcgplayer=two)
    return [owl, fledgling, egg, stray]


@pytest.fixture()
def cards_file(tmp_root):
    path = os.path.join(tmp_root, "landing")
    os.makedirs(path)
    f = os.path.join(path, "card_data_20260120.json")
    with open(f, "w", encoding="utf-8") as fh:
        json.dump(make_cards(), fh, ensure_ascii=True, indent=2)
    return f


AS_OF = dt.datetime(2026, 1, 20, 12, 0, 0)
