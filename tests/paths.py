"""Places that tests read."""

SMALL = "/root/testdata/sf0.001"
