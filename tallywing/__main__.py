from tallywing.jobs import run

run()
