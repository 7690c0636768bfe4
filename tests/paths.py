"""Where the test tables lie; a module of its own, as every folder of tests may have a conftest."""

from pathlib import Path

TESTDATA = Path("/root/testdata")
