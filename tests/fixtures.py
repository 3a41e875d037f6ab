"""Synthetic box-score landing for tests (shapes from FIXTURES.md; no
reference payloads).  Numbers are generated by rule so that every
invariant holds on the clean corpus: player sums equal team rows for the
14 reconciled measures, team turnovers exceed the player sum by one,
team minutes are 240 + 25·overtimes, plus_minus negates per game.

Cases: restated team capture (VIDEO_AVAILABLE 0 → 99), overtime game,
neutral-site game, A→B trade with a gap, A→B→A inside one season, a player
in two seasons, a DNP row (MIN 0, NULL percentages), July games, reordered
headers, a player-grain recapture, an orphan payload without manifest, an
empty envelope under ``_error_cases``.
"""

from __future__ import annotations

import hashlib
import json
import os

from tierline.contracts import DEFAULT_ENDPOINT as ENDPOINT
from tierline.contracts import DEFAULT_SOURCE as SOURCE
from tierline.contracts import PLAYER_COLUMNS, TEAM_COLUMNS

TEAMS = {i: (1610612737 + i, f"T{i:02d}", f"Team {i:02d}") for i in range(4)}
TRADED, BOOMERANG = 2032, 3001

# (game_id, date, home, away, neutral, overtimes, season, season_id)
GAMES = [
    ("0020300001", "2003-11-01", 0, 1, False, 0, "2003-04", "22003"),
    ("0020300002", "2003-11-03", 2, 0, False, 0, "2003-04", "22003"),
    ("0020300003", "2003-11-05", 1, 2, False, 0, "2003-04", "22003"),
    ("0020300004", "2003-11-08", 3, 0, False, 1, "2003-04", "22003"),
    ("0020300005", "2003-11-10", 1, 3, True, 0, "2003-04", "22003"),
    ("0020300006", "2003-11-12", 0, 3, False, 0, "2003-04", "22003"),
    ("0021900001", "2020-07-30", 0, 1, False, 0, "2019-20", "22019"),
    ("0021900002", "2020-07-31", 1, 2, False, 0, "2019-20", "22019"),
    ("0021900003", "2020-08-02", 2, 0, False, 0, "2019-20", "22019"),
    ("0021900004", "2019-10-25", 3, 1, False, 0, "2019-20", "22019"),
]
DNP = (1000, "0021900001")  # player 1000 dressed but did not play in this game
RENAMED_TEAM = {("22019", 2): "Team 02 Renamed"}
SHORTER_NAME = {("22019", 1000): "P1000"}


def roster(team: int, game_id: str) -> list[int]:
    base = [1000 + team * 10 + k for k in range(3)]
    if game_id in ("0020300001", "0020300002") and team == 0:
        base.append(TRADED)
    if game_id in ("0020300004", "0020300005", "0020300006") and team == 3:
        base.append(TRADED)
    if game_id in ("0020300001",) and team == 1:
        base.append(BOOMERANG)
    if game_id in ("0020300002",) and team == 2:
        base.append(BOOMERANG)
    if game_id in ("0020300003",) and team == 1:
        base.append(BOOMERANG)
    return base


def _pct(m, a):
    return None if a == 0 else round(m / a, 3)


def player_stats(p: int, g: int, dnp: bool) -> dict:
    if dnp:
        z = dict.fromkeys(["MIN", "FGM", "FGA", "FG3M", "FG3A", "FTM", "FTA", "OREB", "DREB", "REB", "AST", "STL",
                           "BLK", "TOV", "PF", "PTS", "PLUS_MINUS"], 0)
        z.update(FG_PCT=None, FG3_PCT=None, FT_PCT=None, FANTASY_PTS=0.0)
        return z
    fgm = (p + g) % 5 + 1
    fga = fgm + p % 3 + 1
    fg3m = fgm // 2
    fg3a = fg3m + 1
    ftm = p % 4
    fta = ftm + 1
    oreb, dreb = p % 2, 3 + p % 3
    s = dict(MIN=20 + p % 7, FGM=fgm, FGA=fga, FG3M=fg3m, FG3A=fg3a, FTM=ftm, FTA=fta, OREB=oreb, DREB=dreb,
             REB=oreb + dreb, AST=p % 5, STL=1, BLK=p % 2, TOV=1 + p % 2, PF=2,
             PTS=2 * (fgm - fg3m) + 3 * fg3m + ftm, PLUS_MINUS=(p % 7) - 3)
    s.update(FG_PCT=_pct(fgm, fga), FG3_PCT=_pct(fg3m, fg3a), FT_PCT=_pct(ftm, fta),
             FANTASY_PTS=round(s["PTS"] + 1.2 * s["REB"] + 1.5 * s["AST"], 1))
    return s


SUMMED = ["FGM", "FGA", "FG3M", "FG3A", "FTM", "FTA", "OREB", "DREB", "REB", "AST", "STL", "BLK", "TOV", "PF", "PTS"]


def game_rows(game) -> tuple[list[dict], list[dict]]:
    gid, date, home, away, neutral, ot, _season, season_id = game
    gi = int(gid[-4:])
    players, teams = [], []
    sides = [(home, away), (away, home)]
    totals = {}
    for t, o in sides:
        tot = dict.fromkeys(SUMMED, 0)
        for p in roster(t, gid):
            s = player_stats(p, gi, (p, gid) == DNP)
            for k in SUMMED:
                tot[k] += s[k]
            players.append((t, o, p, s))
        totals[t] = tot
    diff = totals[home]["PTS"] - totals[away]["PTS"]
    for t, o in sides:
        tid, abbr, name = TEAMS[t]
        name = RENAMED_TEAM.get((season_id, t), name)
        oabbr = TEAMS[o][1]
        is_home = t == home and not neutral
        matchup = f"{abbr} vs. {oabbr}" if is_home else f"{abbr} @ {oabbr}"
        tot = totals[t]
        pm = diff if t == home else -diff
        wl = "W" if pm > 0 else "L"
        teams.append(dict(
            SEASON_ID=season_id, TEAM_ID=tid, TEAM_ABBREVIATION=abbr, TEAM_NAME=name, GAME_ID=gid, GAME_DATE=date,
            MATCHUP=matchup, WL=wl, MIN=240 + 25 * ot, **{k: tot[k] for k in SUMMED if k != "TOV"},
            TOV=tot["TOV"] + 1, FG_PCT=_pct(tot["FGM"], tot["FGA"]), FG3_PCT=_pct(tot["FG3M"], tot["FG3A"]),
            FT_PCT=_pct(tot["FTM"], tot["FTA"]), PLUS_MINUS=pm, VIDEO_AVAILABLE=0))
        for (_t, _o, p, s) in [x for x in players if x[0] == t]:
            players_row = dict(
                SEASON_ID=season_id, PLAYER_ID=p, PLAYER_NAME=SHORTER_NAME.get((season_id, p), f"Player {p}"),
                TEAM_ID=tid, TEAM_ABBREVIATION=abbr,
                TEAM_NAME=name, GAME_ID=gid, GAME_DATE=date, MATCHUP=matchup, WL=wl, VIDEO_AVAILABLE=1, **s)
            teams[-1].setdefault("_players", []).append(players_row)
    player_rows = [r for t in teams for r in t.pop("_players")]
    return player_rows, teams


def envelope(headers, rows: list[dict], resource="leaguegamelog") -> dict:
    return {"resource": resource, "parameters": {"LeagueID": "00"},
            "resultSets": [{"name": "LeagueGameLog", "headers": list(headers),
                            "rowSet": [[r[h] for h in headers] for r in rows]}]}


def write_capture(root, season, grain, capture, env: dict, manifest: bool = True, season_type="regular"):
    d = os.path.join(root, SOURCE, ENDPOINT, f"season={season}", f"grain={grain}", f"season_type={season_type}",
                     f"capture={capture}")
    os.makedirs(d, exist_ok=True)
    body = (json.dumps(env, separators=(",", ":")) + "\n").encode()
    with open(os.path.join(d, "payload.json"), "wb") as f:
        f.write(body)
    if manifest:
        m = {"manifest_version": 1, "source": SOURCE, "endpoint": ENDPOINT, "season": season, "grain": grain,
             "season_type": season_type, "capture": capture, "landing_key": f"{season}/{grain}/{season_type}",
             "captured_at": f"{capture[:4]}-{capture[4:6]}-{capture[6:8]}T{capture[9:11]}:{capture[11:13]}:"
                            f"{capture[13:15]}+00:00",
             "parameters": {"Season": season}, "request_url": None, "http_status": 200,
             "row_count": len(env["resultSets"][0]["rowSet"]), "payload_filename": "payload.json",
             "payload_bytes": len(body), "payload_sha256": hashlib.sha256(body).hexdigest(), "client": "fixture",
             "client_version": "0", "elapsed_seconds": 0.1, "provenance": None}
        with open(os.path.join(d, "manifest.json"), "w") as f:
            f.write(json.dumps(m) + "\n")
    return d


C1, C2, C3 = "20260815T120000Z", "20260815T120030Z", "20260815T130000Z"


def build_landing(root: str) -> dict:
    by_season: dict[str, tuple[list, list]] = {}
    for g in GAMES:
        p, t = game_rows(g)
        acc = by_season.setdefault(g[6], ([], []))
        acc[0].extend(p)
        acc[1].extend(t)
    p03, t03 = by_season["2003-04"]
    p19, t19 = by_season["2019-20"]
    write_capture(root, "2003-04", "player", C1, envelope(PLAYER_COLUMNS, p03))
    write_capture(root, "2003-04", "team", C1, envelope(TEAM_COLUMNS, t03))
    restated = [dict(r) for r in t03 if r["GAME_ID"] == "0020300003"]
    for r in restated:
        if r["TEAM_ID"] == TEAMS[1][0]:
            r["VIDEO_AVAILABLE"] = 99
    write_capture(root, "2003-04", "team", C2, envelope(TEAM_COLUMNS, restated))
    write_capture(root, "2019-20", "player", C1, envelope(PLAYER_COLUMNS, p19))
    re_p = [dict(r) for r in p19 if r["GAME_ID"] == "0021900002"]
    for r in re_p:
        r["FANTASY_PTS"] = r["FANTASY_PTS"] + 0.5
    write_capture(root, "2019-20", "player", C2, envelope(PLAYER_COLUMNS, re_p))
    write_capture(root, "2019-20", "team", C1, envelope(tuple(reversed(TEAM_COLUMNS)), t19))
    orphan = [dict(r) for r in t19 if r["GAME_ID"] == "0021900002"]
    for r in orphan:
        r["PTS"] += 100
    write_capture(root, "2019-20", "team", C3, envelope(TEAM_COLUMNS, orphan), manifest=False)
    err = os.path.join(root, SOURCE, ENDPOINT, "_error_cases", "impossible")
    os.makedirs(err, exist_ok=True)
    with open(os.path.join(err, "payload.json"), "w") as f:
        f.write(json.dumps(envelope(TEAM_COLUMNS, [])) + "\n")
    seed = os.path.join(root, "known_trade_expectations.csv")
    t0, t1, t2, t3 = (TEAMS[i][0] for i in range(4))
    with open(seed, "w") as f:
        f.write("player_id,player_name,as_of_date,expected_team_id,expected_team_name,expectation_kind,note\n")
        f.write(f"{TRADED},Player {TRADED},2003-11-03,{t0},Team 00,observed,last game before the trade\n")
        f.write(f"{TRADED},Player {TRADED},2003-11-06,{t0},Team 00,interpolated,gap day belongs to old team\n")
        f.write(f"{TRADED},Player {TRADED},2003-11-08,{t3},Team 03,observed,first game after the trade\n")
        f.write(f"{BOOMERANG},Player {BOOMERANG},2003-11-01,{t1},Team 01,observed,first spell\n")
        f.write(f"{BOOMERANG},Player {BOOMERANG},2003-11-04,{t2},Team 02,interpolated,gap inside second spell\n")
        f.write(f"{BOOMERANG},Player {BOOMERANG},2003-11-05,{t1},Team 01,observed,return to first team\n")
    return {"root": root, "seed": seed, "players": p03 + p19, "teams": t03 + t19}
