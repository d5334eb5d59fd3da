"""A feed of one page an hour that answers with 90 at most."""

from datetime import timedelta


def fetch(query, start, end):
    out, at = [], start
    while at < end:
        out.append((f"https://a.example.com/{'sport' if at.hour == 3 else 'news'}/{at:%Y%m%d%H}", f"{query} {at.hour}", at))
        at += timedelta(minutes=30)
    return [*out[:90], ("https://a.example.com/news/undated", query, None)][:90]
