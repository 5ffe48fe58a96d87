from footlink.plans.cli import main

main()
