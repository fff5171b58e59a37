"""From raw statistic files to scouting marts."""
