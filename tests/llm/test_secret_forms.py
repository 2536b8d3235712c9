"""More forms of assignments, and the time that hostile texts take."""

from __future__ import annotations

import time

import pytest

from tessaria.llm import secret_scan

KEY = "hV83kd02Lq91"


def flow(source):
    return {source[a:b] for a, b in secret_scan.flows(source)}


@pytest.mark.parametrize(
    "source",
    [
        f'db_password = f"{KEY}"\n',
        f"auth_token = b'{KEY}'\n",
        f'auth_token = rb"{KEY}"; other = 1\n',
        f'string dbPassword = @"{KEY}";\n',
        f"api_secret = '''{KEY}'''\n",
        f'api_secret = """{KEY}"""  # said "so"\n',
        f'cfg["{"x" * 90}_password"] = "{KEY}"\n',
        f'cfg["{"x" * 900}_password"] = "{KEY}"\n',
        f"app:\n  client_secret: |\n    {KEY}\n  next: 1\n",
        f"private_key: >-\r\n  -----BEGIN PRIVATE KEY-----\r\n  {KEY}\r\n\r\n  -----END PRIVATE KEY-----\r\n",
        f'<add key="DbPassword" value="{KEY}"/>\n',
        f"<property value='{KEY}' name='db.password' />",
        f"<db><dbPassword>{KEY}</dbPassword></db>",
    ],
)
def test_forms(source):
    assert flow(source) == {KEY}


def test_parts_side_by_side():
    assert flow('private_key = "hV83" "kd02Lq91xx"\n') == {"hV83", "kd02Lq91xx"}
    assert flow('private_key = "hV83" f"kd02" + "Lq91xx"\n') == {"hV83", "kd02", "Lq91xx"}
    assert flow('a = "hV83kd02"\nprivate_key = concat(a, "Lq91xx77")\n') == {"hV83kd02", "Lq91xx77"}
    assert flow('private_key = "".join(["hV83kd02", other, "Lq91xx77"])\n') == {"hV83kd02", "Lq91xx77"}
    assert flow(f'auth_token = lookup("{KEY}")\n') == flow('x = join("hV83kd02", "Lq91xx77")\n') == set()
    assert flow(f"client_secret: |\n  words of a sentence\n  {KEY}\nother: 1\n") == set()
    assert flow(f"notes: |\n  {KEY}\n<p>{KEY}</p><add key='colour' value='{KEY}'/>\n") == set()


@pytest.mark.parametrize(
    "hostile",
    [
        "a: |\n" + "  x\n" * 100_000,
        "a: |\n" * 100_000,
        "<a b=" * 100_000,
        "<a>" * 100_000,
        "<a>b</" * 100_000,
        'x = """' * 50_000,
        "k = ''''" * 50_000,
        "p = f'a' b'" * 50_000,
        '["a" ] = "b' * 50_000,
        " " * 200_000 + ": |\n",
        "\n \n" * 100_000,
        "<" + "a" * 200_000 + ">" + "b" * 200_000,
        "<a " + "b='c' " * 50_000 + ">",
    ],
    ids=range(13),
)
def test_time_of_hostile_texts(hostile):
    began = time.process_time()
    secret_scan.scan(hostile)
    assert time.process_time() - began < 10
