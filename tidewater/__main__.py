import sys

from tidewater.cli import main

main(sys.argv[1:])
