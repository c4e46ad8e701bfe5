"""For ``spark-submit submit.py COMMAND ...``; the commands are those of ``python -m moraine``."""

from moraine.cli import main

main()
