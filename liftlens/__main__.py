from liftlens.cli import run

run()
