"""Helpers of these tests."""

import re

SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def lower_ascii(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text)
