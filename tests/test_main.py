from __future__ import annotations

import json

import pytest

from strata.__main__ import main, parse_args

from tests.helpers import land, quote


def test_arguments():
    args = parse_args(["--lake", "l", "--landing", "dolares=a=b", "cotizaciones=c", "--bodies"])
    assert args.mode == "full"
    assert args.landing == {"dolares": "a=b", "cotizaciones": "c"}
    assert args.bodies and not args.keep_ties and args.extra_fields == []
    more = ["--extra-fields", "a", "b", "--keep-ties", "--drop-repeats", "--all-files"]
    args = parse_args(["--lake", "l", "--landing", "dolares=a", *more])
    assert args.extra_fields == ["a", "b"] and args.all_files and args.drop_repeats


@pytest.mark.parametrize(
    "argv",
    [
        ["--lake", "l"],
        ["--lake", "l", "--landing", "a=b", "--responses", "r"],
        ["--lake", "l", "--landing", "nopath"],
        ["--lake", "l", "--landing", "a=b", "--mode", "stream"],
        ["--landing", "a=b"],
        ["--lake", "l", "--landing", "a=b", "--mode", "sometimes"],
    ],
)
def test_bad_arguments(argv):
    with pytest.raises(SystemExit):
        parse_args(argv)


def test_run(spark, tmp_path, capsys):
    landing = land(tmp_path / "landing", dolares=[quote()], cotizaciones=[quote(moneda="EUR")])
    paths = [f"{source}={path}" for source, path in landing.items()]
    main(["--lake", str(tmp_path / "lake"), "--bodies", "--landing", *paths])
    assert json.loads(capsys.readouterr().out.splitlines()[-1])["silver"] == 2
