"""Tags of broken pages: the same as by plain rules, and in linear time."""

import random
import re
import time

import pytest

from shelfdiff.sources.html import auction_items, page_links
from shelfdiff.sources.markup import tags

# The rules written as one pattern that starts anew at every `<`.
PLAIN = re.compile(
    r"""<!--.*?-->|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<[!?][^>]*>""", re.S
)


def test_tags_equal_plain_rules():
    r = random.Random(2)
    parts = ["<a", "<b ", "</a>", ">", '"', "'", "x", " ", "<!--", "-->", "<!x", "<?y>", "<", "/", "=", "<p>", "</"]
    for n in range(4000):
        page = "".join(r.choice(parts) for _ in range(r.randint(1, 18)))
        expected = [(m.start(), m.end(), bool(m[1]), m[2] or "", m[3] or "") for m in PLAIN.finditer(page)]
        assert list(tags(page)) == expected, page


BROKEN = {
    "open quotes": '<a "' * 250_000,
    "no ends": "<a " * 330_000 + ">",
    "mixed quotes": "<a \"'" * 200_000 + ">",
    "unknown ends": "<div>" * 60_000 + "</p>" * 160_000,
    "open comments": "<!--x>" * 160_000,
    "one long name": "<" + "a" * 1_000_000,
    "stray signs": "a<3 " * 250_000,
}


@pytest.mark.parametrize("name", BROKEN)
def test_broken_pages_of_a_megabyte_take_linear_time(name):
    began = time.process_time()
    auction_items(BROKEN[name])
    page_links(BROKEN[name])
    assert time.process_time() - began < 4, name
