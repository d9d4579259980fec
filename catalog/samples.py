"""Parameters of the registered queries, shared with the SQL they are checked against."""

CUT_BLOCK = 1200          # change point, or last stored block, of the incremental queries
LATE_FROM, LATE_TO = 400, 450   # blocks withheld and delivered late
RANGE_FROM, RANGE_TO = 300, 1800
WAITING_CUT = 1000
POINT_BLOCK = 995         # has an older version as well
DAMAGED = (0, 7)          # blocks removed from the damaged copies
LOST_FROM, LOST_TO = 700, 900   # blocks whose turnover is removed
CHECK_FROM, CHECK_TO = 650, 800   # range of the check that covers some of them
REPORTED = 5              # lines per check in the text report
BEFORE_TIME = "1998-03-01"
FIRST_MONTH = "1996-03-01"
CUT_MONTH = "1999-01-01"
ADDRESS = "s5"
MIN_SATS = 1_000_000
AHEAD = 30                # numbers the index of available blocks reaches beyond the last stored one
FILE_BLOCKS = 100         # blocks per source file in resume_file
