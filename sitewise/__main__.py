from sitewise.cli import main

main()
