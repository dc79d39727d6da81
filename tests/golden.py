"""Small hand-written captures in the shapes of FIXTURES.md."""

from __future__ import annotations

import json
from datetime import datetime, timezone

from meetlake.sources.schemas import CAPTURES

T0 = datetime(2026, 1, 1, tzinfo=timezone.utc)
BASE = "https://example.com"


def capture(kind, url, body, at=T0, status=200, country=None, event_name=None):
    if not isinstance(body, str) and body is not None:
        body = json.dumps(body)
    return (url, kind, at, status, None, "text/html", country, event_name, body)


def captures(spark, *rows):
    return spark.createDataFrame(list(rows), CAPTURES)


def registration(user_id, **fields):
    base = {
        "id": user_id * 10, "approved": 1, "status": "ok", "club_id": 1, "age": 30,
        "birth": "1990", "clubName": "", "cn": "br", "country": "Brazil", "firstname": "Ana",
        "middle_name": "", "lastname": f"L{user_id}", "gender": "f", "profile_image": "i.png",
        "affiliationName": "Aff", "seed_position": None, "teamName": None, "user_id": user_id,
        "trashed": 0, "categories": [],
    }
    return base | fields


def group(name, *regs):
    return {"id": 1, "event_id": 7, "name": name, "registrations": list(regs) or None}


def participants(*groups, **more):
    return {"participants": list(groups), "categories": []} | more


PROFILE = """<html><body>
<div class="well-skillevel"><strong class="font-size-md"> Purple  Belt II </strong></div>
<ul class="fights_wins_legend">
  <li><span class="total">3</span><span class="type">Submission</span></li>
  <li><strong>2</strong> by points</li>
  <li><strong>x</strong> by decision</li>
</ul>
<ul class="fights_losses_legend">
  <li><span class="total">1</span> <span class="type">Submission, decision</span></li>
  <li><span class="total">4</span> <span class="type">submission or decision</span></li>
</ul>
<dl><dt>Wins</dt><dd>1,234</dd><dt>Belt</dt><dd>Blue 9</dd><dt>Wins by points</dt><dd>99</dd></dl>
<div class="stat-item"><span class="label">Losses by DQ</span><span class="value">6</span></div>
<table><tr><th>Wins by decision</th><td>8</td></tr></table>
<ul>
  <li>Losses by points: 5</li>
  <li><span class="label label-danger">WIN</span> by dq</li>
  <li><span class="label label-danger">LOSS</span> by points</li>
</ul>
</body></html>"""

FIGHTS_ONLY = """<html><body><div class="well-skillevel"><p class="font-size-md">New comer</p></div>
<ul><li><b class="label-success">W</b> Submission
<li><b class="label-success">W</b> Decision on points
<li><b class="label-danger">L</b> Disqualification
<li>no mark</ul></body></html>"""

ACADEMY = """<html><body><h1> Gracie / São 1 </h1><span class="club-name">Other</span>
<img class="club-logo" src="/img/l.png"><img class="club-cover" src="https://cdn.test/c.png">
<p class="club-bio"> Fine club </p>
<a href="https://instagram.com/g">i</a><a href="https://g.test">w</a>
<a href="https://example.com/en/x">own</a><a href="http://facebook.com/g">f</a>
<div class="stat-item"><b class="stat-label">Wins</b><b class="stat-value">1,234</b></div>
<div class="stats-item"><b class="label">Wins total</b><b class="value">1,235</b></div>
<div class="stat-item"><b class="stat-label">Members</b><b class="stat-value">x7</b></div>
<div class="stat-item"><b class="stat-label">Gold</b><b class="stat-value">+7</b></div>
</body></html>"""

CARDS = """<html><body><div class="margin-bottom-xs-64"><h2> This week </h2><div>
<div class="event-card"><a class="image-container" href="/en/event/5"><img src=" c.png "></a>
 <a class="event-title" href="/en/event/5"> Open 5 </a>
 <i class="flag-icon flag-icon-ar"></i>
 <p class="location"><span>Rosario,</span><span> , </span><span>Santa Fe</span><span>Argentina</span></p>
 <span class="date"> May 1 </span><span class="days">in 3 days</span></div>
<div class="event-card"><a class="image-container" href="en/event/6"></a><a class="event-title">Six</a>
 <p class="location"><span>Chile</span></p></div>
<div class="event-card"><a class="event-title" href="/en/event/7"> </a></div>
</div></div></body></html>"""

EVENTS = [
    {"id": 11, "title": " A ] \"q\" ", "url": f"{BASE}/en/event/11", "cover_image": "",
     "cover_image_fallback": " f.png", "days_to_start": 5, "eventPeriod": "May",
     "location_country": "br", "location_country_human": "Brazil", "location_city": "Rio",
     "eventEnded": False, "startdate": "x", "enddate": "y", "extra": [1, {"k": "]"}]},
    {"id": 12, "title": "B", "url": f"{BASE}/en/event/12", "days_to_start": -3},
    {"id": 13, "title": "C", "url": "", "days_to_start": 0},
    {"id": 14, "title": " ", "url": f"{BASE}/en/event/14", "days_to_start": None},
]


def listing(events):
    return f"<html><script>var events = {json.dumps(events)}; var z = [1];</script>{CARDS}</html>"


LD = {
    "@type": " sportsevent ", "name": "Ev", "startDate": "s", "endDate": "e", "image": "i",
    "description": "d", "url": "u",
    "location": {"name": "", "address": {"addressLocality": "Rio", "addressCountry": "",
                                         "description": ""}},
    "organizer": {"name": ""},
}


def event_page(*scripts):
    tags = "".join(f'<script type="application/ld+json">{s}</script>' for s in scripts)
    return f"<html><head>{tags}</head><body>x</body></html>"
